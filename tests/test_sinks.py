"""Sinks: Parquet, CSV (empty and null), catalog tables, report sets, load status."""

import pytest
from pyspark.sql import types as T

from rxcover.sinks import releases, writers
from rxcover.sources.tables import load_status

SCHEMA = T.StructType([T.StructField("vpid", T.StringType()), T.StructField("atc_code", T.StringType()),
                       T.StructField("ddd", T.DoubleType())])


def frame(spark):
    return spark.createDataFrame([("1", "", 1.5), ("2", None, None), ("3", "J01", 2.0)], SCHEMA)


def test_parquet_keeps_empty_and_null_apart(spark, tmp_path):
    p = str(tmp_path / "t.parquet")
    writers.write_parquet(frame(spark), p)
    got = sorted(tuple(r) for r in spark.read.parquet(p).collect())
    assert got == [("1", "", 1.5), ("2", None, None), ("3", "J01", 2.0)]


def test_csv_prints_empty_and_null_as_nothing(spark, tmp_path):
    p = str(tmp_path / "t.csv")
    writers.write_csv(frame(spark).coalesce(1), p)
    text = "".join(open(f).read() for f in sorted((tmp_path / "t.csv").glob("part-*")))
    lines = sorted(text.strip().splitlines())
    assert lines == sorted(["vpid,atc_code,ddd", "1,,1.5", "2,,", "3,J01,2.0"])
    back = sorted(tuple(r) for r in writers.read_csv(spark, p, SCHEMA).collect())
    assert back == [("1", None, 1.5), ("2", None, None), ("3", "J01", 2.0)]


def test_csv_keeps_every_text(spark, tmp_path):
    names = ['say "x", y', "two\nlines", "crlf\r\nend", "  pad ", "back\\", '"', "a,b", "\ttab\t", "é\u3000"]
    df = spark.createDataFrame([(n, str(i), float(i)) for i, n in enumerate(names)], SCHEMA)
    p = str(tmp_path / "odd.csv")
    writers.write_csv(df, p)
    got = sorted((r["atc_code"], r["vpid"]) for r in writers.read_csv(spark, p, SCHEMA).collect())
    assert [n for _, n in got] == names
    text = "".join(open(f, newline="").read() for f in (tmp_path / "odd.csv").glob("part-*"))
    assert '"say ""x"", y"' in text


def test_catalog_tables_replace(spark, tmp_path):
    loc = str(tmp_path / "db")
    names = writers.save_tables(spark, {"spine": frame(spark)}, "rxcover_test", location=loc)
    assert spark.table(names["spine"]).count() == 3
    writers.save_tables(spark, {"spine": frame(spark).limit(1)}, "rxcover_test", location=loc)
    assert spark.table(names["spine"]).count() == 1
    # a new session's catalog no longer lists the table; the rebuild still replaces it
    spark.sql("DROP TABLE rxcover_test.spine")
    writers.save_tables(spark, {"spine": frame(spark)}, "rxcover_test", location=loc)
    assert spark.table(names["spine"]).count() == 3


def test_a_failed_second_table_leaves_all_old(spark, tmp_path, monkeypatch):
    a, b, c = (str(tmp_path / x) for x in "abc")
    for p, n in ((a, 3), (b, 2), (c, 1)):
        writers.write_parquet(frame(spark).limit(n), p)
    names = releases.point_tables(spark, {"x": a, "y": b}, "rxcover_point_test")
    with pytest.raises(Exception):  # noqa: B017
        releases.point_tables(spark, {"x": c, "z": c, "y": str(tmp_path / "missing") + "'"}, "rxcover_point_test")
    assert [spark.table(names[t]).count() for t in "xy"] == [3, 2]
    assert not spark.catalog.tableExists("rxcover_point_test.z")
    releases.point_tables(spark, {"x": c, "y": c}, "rxcover_point_test")
    assert [spark.table(names[t]).count() for t in "xy"] == [1, 1]


def test_catalog_managed_tables(spark):
    names = writers.save_tables(spark, {"t": frame(spark)}, "rxcover_managed_test")
    writers.save_tables(spark, {"t": frame(spark).limit(2)}, "rxcover_managed_test")
    assert spark.table(names["t"]).count() == 2


def test_write_reports(spark, tmp_path):
    paths = writers.write_reports({"a": frame(spark), "b": frame(spark).limit(2)}, str(tmp_path / "r"))
    assert {k: spark.read.parquet(v).count() for k, v in paths.items()} == {"a": 3, "b": 2}


def test_load_status(spark, tmp_path):
    p = str(tmp_path / "s.parquet")
    writers.write_parquet(frame(spark), p)
    got = {r["source"]: (r["file_exists"], r["rows"], r["message"])
           for r in load_status(spark, {"spine": p, "missing": str(tmp_path / "nope.parquet")}).collect()}
    assert got == {"spine": (True, 3, "Loaded 3 records."),
                   "missing": (False, None, "Data file not found. Run pipeline first.")}
