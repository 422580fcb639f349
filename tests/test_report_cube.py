"""Every bundled report computed from the count cube equals the report
computed from the rows."""

from rxcover.operators import prepared as pr
from rxcover.operators import reports as rp
from rxcover.plans.queries import prepared
from tests.conftest import SMALL_SF


def rows_of(df):
    return sorted(tuple("<null>" if v is None else repr(v) for v in r) for r in df.collect())


def test_cube_reports_equal_row_reports(spark):
    prep = prepared(spark, SMALL_SF)
    direct = rp.report_bundle(prep, pr.antibiotics(prep))
    cube = rp.report_cube(prep)
    from_cube = rp.report_bundle(cube, pr.antibiotics(cube))
    assert cube.count() < prep.count()
    for name in rp.REPORT_NAMES:
        assert direct[name].columns == from_cube[name].columns, name
        assert dict(direct[name].dtypes) == dict(from_cube[name].dtypes), name
        assert rows_of(direct[name]) == rows_of(from_cube[name]), name
    assert rows_of(rp.coverage(prep, group="Anti-Infectives (Systemic)")) == \
        rows_of(rp.coverage(cube, group="Anti-Infectives (Systemic)"))
