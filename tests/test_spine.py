"""Spine build on the XML fixture (FIXTURES.md section 4) and its parts."""

import pytest
from pyspark.sql import functions as F

from rxcover.operators import (
    DuplicateKeyError,
    build_metrics,
    build_spine,
    duplicate_keys,
    join_one_to_many,
    unit_top,
)
from rxcover.sources.xml import read_classifications_xml, read_products_xml
from tests import fixtures as fx

EXPECTED = [
    ("", "No key", None, None, None, "mg", None),
    ("111", "Co-amoxiclav 250mg", None, "J01CR02", 3.0, "mg", 3.0),
    ("222", "Amoxicillin", "050101", "J01CA04", 1.5, "g", 1500.0),
    ("333", "Piperacillin / Tazobactam 4g", "050101", "", 14.0, "g", 14000.0),
    ("444", "Paracetamol", "", "N02BE01", None, "mg", None),
    ("444", "Paracetamol", "040701", "N02BE01", 3.0, "mg", 3.0),
]
COLS = ("vpid", "vmp_nm", "bnf_code", "atc_code", "ddd", "ddd_uom", "ddd_mg")


@pytest.fixture()
def records(spark, tmp_path):
    item24, item25 = fx.release(tmp_path)
    return read_products_xml(spark, item24), read_classifications_xml(spark, item25, row_tags=("VMP", "REC"))


def key(r):
    return tuple("" if v is None else str(v) for v in r)


def table(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=key)


def test_spine_default(spark, records):
    vmp, bnf = records
    spine = build_spine(vmp, bnf)
    assert spine.columns == ["vpid", "vmp_nm", "vtmid", "vpid_prev", "bnf_code", "atc_code", "ddd",
                             "ddd_uom", "ddd_mg"]
    assert dict(spine.dtypes)["ddd"] == "double" and dict(spine.dtypes)["ddd_mg"] == "double"
    assert table(spine) == sorted(EXPECTED, key=key)


def test_spine_fallback_unit_first(spark, records):
    vmp, bnf = records
    got = {r[0]: r for r in table(build_spine(vmp, bnf, fallback_unit_first=True)) if r[0] in ("111", "333")}
    assert got["111"][4:] == (3.0, "g", 3000.0)
    assert got["333"][4:] == (14.0, "g", 14000.0)


def test_spine_sorted_by_vpid_with_ties(spark, records):
    vmp, bnf = records
    got = [(r["vpid"], r["bnf_code"]) for r in build_spine(vmp, bnf, sort=True).collect()]
    assert got == [("", None), ("111", None), ("222", "050101"), ("333", "050101"), ("444", ""),
                   ("444", "040701")]


def test_duplicate_product_raises(spark, records):
    vmp, bnf = records
    dup = vmp.unionByName(vmp.filter(F.col("vpid") == "222"))
    with pytest.raises(DuplicateKeyError):
        build_spine(dup, bnf)
    assert [tuple(r) for r in duplicate_keys(dup).collect()] == [("222", 2)]


def test_join_equals_left_join(spark, records):
    vmp, bnf = records
    ours = join_one_to_many(vmp, bnf).collect()
    plain = vmp.join(bnf, "vpid", "left").select(*join_one_to_many(vmp, bnf).columns).collect()
    assert sorted(map(key, ours)) == sorted(map(key, plain))


def test_build_metrics(spark, records):
    vmp, bnf = records
    got = {r["metric"]: r["value"] for r in build_metrics(vmp, bnf, build_spine(vmp, bnf)).collect()}
    assert got == {"vmp_rows": 5, "bnf_rows": 5, "spine_rows": 6, "non_null_atc": 5, "with_atc": 4}


def test_unit_top(spark, records):
    _, bnf = records
    assert [tuple(r) for r in unit_top(bnf, 10).collect()] == [("", 2), ("g", 2), ("mg", 1)]
    assert [tuple(r) for r in unit_top(bnf, 1).collect()] == [("", 2)]


def test_sort_splits_a_hot_group_of_copies(spark):
    from rxcover.operators.spine import sort_spine

    hot = spark.range(0, 30_000, 1, 8).select(F.lit("555").alias("vpid"), F.lit(2.0).alias("ddd"))
    rest = spark.range(0, 20_000, 1, 8).select(F.col("id").cast("string").alias("vpid"),
                                               (F.col("id") % 5).cast("double").alias("ddd"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sort_spine(hot.unionByName(rest))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        rows = [(r["vpid"], r["ddd"]) for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 50_000 and max(sizes) < 25_000
    assert rows == sorted(rows)


def counted(spark, df):
    """``df`` and an accumulator of the rows that jobs read from it."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    return df.mapInPandas(run, df.schema), seen


def test_staged_build_reads_classifications_once(spark, records, tmp_path):
    """One scan, though rows are joined, told apart and sorted; a lazy sort
    reads them three times."""
    vmp, bnf = records
    bnf = spark.createDataFrame(bnf.collect() * 40, bnf.schema)
    once, seen = counted(spark, bnf)
    got = build_spine(vmp, once, sort=True, stage=str(tmp_path / "stage"))
    rows = [tuple(r) for r in got.collect()]
    assert seen.value == bnf.count()
    lazy, often = counted(spark, bnf)
    assert rows == [tuple(r) for r in build_spine(vmp, lazy, sort=True).collect()]
    assert often.value > bnf.count()


@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("sort", [False, True])
def test_staged_build_equals_lazy_build(spark, records, tmp_path, first, sort):
    vmp, bnf = records
    vmp = vmp.unionByName(vmp.limit(1).withColumn("vpid", F.lit(None).cast("string")))
    for n, (v, b) in enumerate([(vmp, bnf), (vmp, bnf.limit(0)), (vmp.limit(0), bnf), (vmp, bnf.where("vpid = '999'")),
                                (vmp, bnf.withColumn("vpid", F.when(F.col("vpid") != "444", F.col("vpid"))))]):
        lazy = build_spine(v, b, fallback_unit_first=first, sort=sort)
        staged = build_spine(v, b, fallback_unit_first=first, sort=sort, stage=str(tmp_path / f"s{n}"))
        assert staged.columns == lazy.columns and staged.dtypes == lazy.dtypes
        assert table(staged) == table(lazy)


def test_staged_build_of_number_keys(spark, tmp_path):
    vmp = spark.createDataFrame([(k, f"n{k}", "", "") for k in (7, 8, 10)], "vpid int, vmp_nm string, vtmid string, vpid_prev string")
    bnf = spark.createDataFrame([(k, "b", "a", "1", "g") for k in (7, 8, 8, 9)],
                                "vpid int, bnf_code string, atc_code string, ddd string, ddd_uom string")
    lazy, staged = build_spine(vmp, bnf), build_spine(vmp, bnf, stage=str(tmp_path / "s"))
    assert len(table(lazy)) == 4 and table(staged) == table(lazy)
    with pytest.raises(ValueError, match="one type"):
        build_spine(vmp, bnf.withColumn("vpid", F.col("vpid").cast("string")), stage=str(tmp_path / "t"))


def test_staged_build_after_a_failed_one(spark, records, tmp_path):
    """What a failed build left in the stage folder is not read."""
    vmp, bnf = records
    stage = str(tmp_path / "s")
    build_spine(vmp, bnf.withColumn("atc_code", F.lit("OLD")), stage=stage)
    assert table(build_spine(vmp, bnf, stage=stage)) == table(build_spine(vmp, bnf))
