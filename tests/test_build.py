"""End-to-end build and report run on the XML fixture."""

from pathlib import Path

import pytest
from rxcover import build
from rxcover.build import run_build, run_reports
from rxcover.sinks import releases, writers

from tests import fixtures as fx


def test_run_build_and_reports(spark, tmp_path):
    item24, item25 = fx.release(tmp_path)
    out = run_build(spark, item24, item25, str(tmp_path / "out"), database="rxcover_build_test")
    assert out.metrics == {"vmp_rows": 5, "bnf_rows": 5, "spine_rows": 6, "non_null_atc": 5, "with_atc": 4}
    assert out.units == [("", 2), ("g", 2), ("mg", 1)] and out.catalog_error is None
    spine = spark.read.parquet(out.spine)
    assert [r["vpid"] for r in spine.collect()] == ["", "111", "222", "333", "444", "444"]
    assert spark.table(out.tables["spine"]).count() == 6
    csv_lines = sum(len(open(p).read().splitlines()) - 1 for p in Path(out.spine_csv).glob("part-*"))
    assert csv_lines == 6
    assert releases.current(spark, str(tmp_path / "out"))["spine"] == out.spine
    paths = run_reports(spark, str(tmp_path / "out"), str(tmp_path / "reports"))
    cov = {r["mapping_status"]: r["n"] for r in spark.read.parquet(paths["coverage"]).collect()}
    assert cov == {"ATC + BNF": 2, "ATC only": 2, "BNF only": 1, "Unmapped": 1}
    assert spark.read.parquet(paths["summary"]).first()["total"] == 6


def contents(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file()}


@pytest.mark.parametrize("rel,text", [
    ("item_24/f_vmp2_2.xml", "<R><VMP><VPID>111</VPID><NM>again</NM></VMP></R>"),          # a repeated key
    ("item_25/f_bnf1_2.xml", fx.TRUNCATED),                                              # a malformed second file
])
def test_failed_build_leaves_the_old_outputs(spark, tmp_path, rel, text):
    item24, item25 = fx.release(tmp_path)
    run_build(spark, item24, item25, str(tmp_path / "out"))
    before = contents(tmp_path / "out")
    fx.write(tmp_path, rel, text)
    with pytest.raises(Exception):  # noqa: B017
        run_build(spark, item24, item25, str(tmp_path / "out"))
    assert contents(tmp_path / "out") == before


def test_rebuild_replaces_and_catalog_failure_is_reported(spark, tmp_path):
    item24, item25 = fx.release(tmp_path)
    run_build(spark, item24, item25, str(tmp_path / "out"))
    fx.write(tmp_path, "item_24/f_vmp2_2.xml", "<R><VMP><VPID>555</VPID><NM>new</NM></VMP></R>")
    out = run_build(spark, item24, item25, str(tmp_path / "out"), database="no/such`name")
    assert out.catalog_error and not out.tables
    assert spark.read.parquet(out.spine).count() == 7
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]


def tables_of(spark, out, database):
    return {t: sorted(map(tuple, spark.table(f"{database}.{t}").collect())) for t in ("vmp", "bnf", "spine")} | {
        k: sorted(map(repr, spark.read.parquet(v).collect())) for k, v in releases.current(spark, out).items() if k != "spine_csv"}


@pytest.mark.parametrize("where", ["products", "classifications", "spine", "csv", "search", "metrics", "switch"])
def test_a_failure_anywhere_leaves_the_old_release(spark, tmp_path, monkeypatch, where):
    item24, item25 = fx.release(tmp_path)
    out, database = str(tmp_path / "out"), "rxcover_release_" + where
    run_build(spark, item24, item25, out, database=database)
    before, files = tables_of(spark, out, database), contents(tmp_path / "out")
    fx.write(tmp_path, "item_24/f_vmp2_2.xml", "<R><VMP><VPID>555</VPID><NM>new</NM></VMP></R>")
    fx.write(tmp_path, "item_25/f_bnf1_2.xml", "<R><VMP><VPID>555</VPID><ATC>J01</ATC></VMP></R>")

    def fail(*a, **b):
        raise OSError("injected")

    def fail_at(real, end):
        return lambda df, path, *a: fail() if path.endswith(end) else real(df, path, *a)

    ends = {"products": "vmp.parquet", "classifications": "bnf.parquet", "spine": "spine.parquet", "search": "search.parquet"}
    with monkeypatch.context() as m:
        if where in ends:
            m.setattr(writers, "write_parquet", fail_at(writers.write_parquet, ends[where]))
        elif where == "csv":
            m.setattr(writers, "write_csv", fail)
        elif where == "metrics":
            m.setattr(build, "build_metrics", fail)
        else:
            m.setattr(releases, "_switch", fail)
        with pytest.raises(OSError):
            run_build(spark, item24, item25, out, database=database)
    assert tables_of(spark, out, database) == before and contents(tmp_path / "out") == files
    run_build(spark, item24, item25, out, database=database)
    after = tables_of(spark, out, database)
    assert all(len(after[k]) == len(before[k]) + (k != "search") for k in before)     # the new record has no dose


def test_releases_are_pruned(spark, tmp_path):
    item24, item25 = fx.release(tmp_path)
    made = [run_build(spark, item24, item25, str(tmp_path / "out")).spine for _ in range(3)]
    assert [Path(p).exists() for p in made] == [False, True, True]
    assert releases.current(spark, str(tmp_path / "out"))["spine"] == made[-1]
    assert releases.current(spark, str(tmp_path / "none")) is None
