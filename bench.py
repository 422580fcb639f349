"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and run once as warm-up, then three times (BENCH_RUNS);
the result is forced with a ``noop`` write, so the whole plan runs without
collecting to the driver. No input is kept between runs: a report's time holds
the build of its spine, an XML query's the writing of its files. ``run_build``
and ``run_reports`` are the two jobs a user runs, from XML files and from the
built spine. Prints one JSON line: the sum of per-query medians and each median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "spine",
    "coverage",
    "group_coverage",
    "abx_subclass",
    "abx_level4",
    "ddd_lookup",
    "summary",
    "xml_vmp_records",
    "xml_bnf_records",
    "run_build",
    "run_reports",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def bench_release(spark, sf_dir: str, q) -> tuple[str, str]:
    """A release as the build finds it: files named by their item."""
    from pyspark.sql import functions as F

    root = q.run_path(spark, "release")
    raw = {"f_vmp2": (q.tpch.raw_products(q.tpch.read_table(spark, sf_dir, "part")), q.PRODUCT_TAGS),
           "f_bnf": (q.tpch.raw_classifications(q.tpch.read_table(spark, sf_dir, "lineitem")), q.CLASSIFICATION_TAGS)}
    for name, (df, tags) in raw.items():
        q.xsrc.write_xml_records(df.repartition(8, F.col("vpid")), f"{root}/{name}", "VMP", "VMPS", tags)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        fs = folder.getFileSystem(conf)
        for i, f in enumerate(p for p in fs.listStatus(folder) if p.getPath().getName().startswith("part-")):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{name}_{i}.xml"))
    return f"{root}/f_vmp2", f"{root}/f_bnf"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from rxcover.plans.queries import QUERIES
    from rxcover.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="rxcover-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    from rxcover.build import run_build, run_reports
    from rxcover.plans import queries as q

    def build(spark, sf):
        out = run_build(spark, products, classifications, q.run_path(spark, "bench"))
        return spark.read.parquet(out.spine)

    def reports(spark, sf):
        paths = run_reports(spark, spine, q.run_path(spark, "bench"))
        return spark.read.parquet(paths["summary"])

    if {"run_build", "run_reports"} & set(names):
        products, classifications = bench_release(spark, sf_dir, q)
        spine = f"{q.run_path(spark, 'bench')}/spine"
        q.spine(spark, sf_dir).write.parquet(spine)
        QUERIES = QUERIES | {"run_build": build, "run_reports": reports}

    medians = {}
    for name in names:
        run(name)
        medians[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
