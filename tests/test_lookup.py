"""Dose explorer: names, search, plain numbers, ranges and paging."""

from rxcover.operators import lookup as lk
from rxcover.operators.order import rows_after

SCHEMA = "vmp_nm string, atc_code string, ddd double, ddd_uom string, ddd_mg double"
ROWS = [("Amox b", "J01", 0.0005, "g", 0.5), ("Amox a", "J01", 0.0005, "g", 0.5), ("Amox a", "J01", 0.0005, "g", 0.5),
        ("", "J01", 1500.0, "mg", 1500.0), (None, None, 12345678.5, "mg", 12345678.5), ("Z|z", None, 2.0, "g", 2000.0),
        ("none", "A", None, "g", None), ("Solo", "N02", 1e22, "g", None)]


def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted((r["ddd"], r["drug_names"]) for r in df.collect())


def test_lookup(spark):
    assert ids(lk.ddd_lookup(table(spark))) == [(0.0005, "Amox a | Amox b"), (2.0, "Z|z"), (1500.0, ""), (12345678.5, ""),
                                                (1e22, "Solo")]


def test_search_equals_search_of_the_table(spark, tmp_path):
    full = lk.ddd_lookup(table(spark))
    lk.lookup_index(table(spark)).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    for term, cols in (("0.0005", None), ("e-4", None), ("amox b", None), ("12345678.5", None), ("|", None), ("b j01", None),
                       (None, {"ddd": (0.0001, 2.0)}), (None, {"ddd": (None, 0.001)}), (None, {"ddd_mg": (1500.0, None), "atc_code": "j0"}),
                       (None, {"drug_names": "a | amox"}), (None, {"drug_names": "mox a "}), ("AMOX", {"ddd": "000"}), ("z|z", None), ("1500", {"ddd_uom": "MG"}), ("zzz", None), (None, None)):
        assert ids(lk.lookup_search(table(spark), term, cols)) == ids(lk.ddd_search(full, term, cols)), (term, cols)
        assert ids(lk.lookup_search(table(spark), term, cols, index)) == ids(lk.ddd_search(full, term, cols)), (term, cols)
    plan = lk.lookup_search(table(spark), "amox", index=index)._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [amo,mox])" in plan      # the index is read for the wanted runs only
    assert ids(lk.lookup_search(table(spark), "0.0005")) == [(0.0005, "Amox a | Amox b")]
    assert ids(lk.lookup_search(table(spark), "e-4")) == []


def test_pages_follow_each_other(spark):
    full = [tuple(r) for r in lk.ddd_lookup(table(spark)).collect()]
    pages, last = [], None
    while True:
        got = [tuple(r) for r in lk.lookup_page(table(spark), 1, 2, after=last).collect()]
        if not got:
            break
        pages += got
        last = got[-1][:4]
    assert pages == full
    assert [tuple(r) for r in lk.lookup_page(table(spark), 2, 2).collect()] == full[2:4]
    assert rows_after(table(spark), ["atc_code", "ddd"], (None, 2.0)).count() == 1


def test_numbers_are_shown_plain_at_any_magnitude(spark):
    from decimal import Decimal

    values = [0.0, -0.0, 1.0, 1500.0, 5e-4, 5e-19, 1e20, 1.5e21, 123456789.125, -2.5e-7, 1e7, 12345678.9, 1e300, -9.99e15, 0.1, 100.0, 1.2e-3]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", lk.shown("x", "double").alias("s")).collect()
    for r in rows:
        want = f"{Decimal(repr(r.x + 0.0)):f}"
        assert r.s == (want.rstrip("0").rstrip(".") if "." in want else want)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double").select(lk.shown("x", "double").alias("s")).collect()
    assert [r.s for r in odd] == ["NaN", "Infinity", None]
    tiny = spark.createDataFrame([("A", 5e-19), ("B", 2e20)], "atc_code string, ddd double")
    assert [r.atc_code for r in lk.ddd_search(tiny, "0000005").collect()] == ["A"]
    assert [r.atc_code for r in lk.ddd_search(tiny, "200000000000000000000").collect()] == ["B"]
