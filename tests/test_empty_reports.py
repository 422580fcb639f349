"""Reports without rows or without antibiotics; hot keys; the catalog query."""

import pytest
from pyspark.sql import functions as F
from rxcover.build import run_reports
from rxcover.operators import reports as rp
from rxcover.operators.prepared import antibiotics, prepare
from rxcover.operators.spine import join_one_to_many
from rxcover.plans import queries as q

from tests.conftest import SMALL_SF

SCHEMA = ("vpid string, vmp_nm string, vtmid string, vpid_prev string, bnf_code string, atc_code string, ddd double, "
          "ddd_uom string, ddd_mg double")
PLAIN = [("1", "Paracetamol", "", "", "0407", "N02BE01", 3.0, "g", 3000.0), ("2", "x", "", "", None, None, None, "mg", None)]


@pytest.mark.parametrize("rows", [[], PLAIN])
def test_reports_without_antibiotics(spark, tmp_path, rows):
    spine = spark.createDataFrame(rows, SCHEMA)
    prep = prepare(spine)
    bundle = rp.report_bundle(prep, antibiotics(prep))
    assert set(bundle) == set(rp.REPORT_NAMES)
    for df in bundle.values():
        df.collect()
    assert [(r["n"], r["pct"], r["label"]) for r in bundle["abx_status_long"].collect()] == [(0, None, None)] * 3
    s = bundle["summary"].first()
    assert s["total"] == len(rows) and s["pct_bnf"] == (50.0 if rows else None) and s["label"] == f"Total VMPs: {len(rows)}"
    spine.write.parquet(str(tmp_path / "spine"))
    paths = run_reports(spark, str(tmp_path / "spine"), str(tmp_path / "out"))
    assert spark.read.parquet(paths["summary"]).count() == 1 and len(paths) == len(rp.REPORT_NAMES)


def test_labels(spark):
    rows = [(str(i), "n", "", "", "0501", "J01CA04" if i % 3 else None, 1.0, "g", 1000.0) for i in range(1200)]
    prep = prepare(spark.createDataFrame(rows, SCHEMA))
    abx = antibiotics(prep)
    assert sorted(r["pct_label"] for r in rp.coverage_labels(prep).collect()) == ["33.3%", "66.7%"]
    assert {r["label"] for r in rp.abx_subclass_total(abx).collect()} == {"400", "800"}
    assert [r["label"] for r in rp.abx_status_long(abx).collect()] == ["66.7%", "33.3%", "0.0%"]
    assert [r["label"] for r in rp.group_gap_rate(prep).collect()] == ["0%"]
    assert rp.summary(prep).first()["label"] == "Total VMPs: 1,200"


def partition_sizes(spark, df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_unmapped_list_splits_a_hot_name(spark):
    hot = spark.range(0, 30_000, 1, 8).select(F.lit("5").alias("vpid"), F.lit("hot").alias("vmp_nm"), F.lit("0501").alias("bnf_code"),
                                              F.lit("BNF only").alias("mapping_status"), F.lit(False).alias("has_atc"))
    rest = spark.range(0, 20_000, 1, 8).select(F.col("id").cast("string").alias("vpid"), F.col("id").cast("string").alias("vmp_nm"),
                                               F.lit("0501").alias("bnf_code"), F.lit("BNF only").alias("mapping_status"),
                                               F.lit(False).alias("has_atc"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = rp.abx_missing(hot.unionByName(rest), display_names=False)
        sizes = partition_sizes(spark, out)
        names = [r["vmp_nm"] for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 50_000 and max(sizes) < 25_000 and names == sorted(names)


def test_hot_product_is_a_skew_join(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(2000).select(F.col("id").cast("string").alias("vpid"), F.lit("n").alias("vmp_nm"))
        right = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit("7")).otherwise((F.col("id") % 2000).cast("string")).alias("vpid"),
            F.sha2(F.col("id").cast("string"), 256).alias("bnf_code"))
        out = join_one_to_many(left, right, "vpid")
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["vpid"] == "7" for r in rows) > 30_000
    assert "skew=true" in plan


def test_catalog_query_follows_its_input(spark):
    counts = [q.q_catalog_tables(spark, d).count() for d in (SMALL_SF, "/root/testdata/sf0.01", SMALL_SF)]
    assert counts[0] == counts[2] != counts[1]
