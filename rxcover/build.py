"""The two jobs users run: the build (XML release -> record tables, spine,
CSV copy, catalog tables) and the report run (spine -> one table per chart).

The build writes each stage as Parquet and reads it back before the next:
the XML is parsed once however many sinks follow, every later step reads
columnar data with pruning and pushdown, and a lost executor re-runs at most
the stage it was in (the written tables cut the lineage). Everything goes
through Spark's commit protocol into the output folder, which must be
shared by the cluster.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from rxcover.operators.lookup import lookup_index
from rxcover.operators.prepared import antibiotics, prepare
from rxcover.operators.reports import report_bundle, report_cube
from rxcover.operators.spine import build_metrics, build_spine, unit_top
from rxcover.sinks import releases, writers
from rxcover.sources.xml import read_classifications_xml, read_products_xml


@dataclass
class BuildOutputs:
    products: str
    classifications: str
    spine: str
    spine_csv: str
    search: str
    tables: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, int] = field(default_factory=dict)
    units: list[tuple[str, int]] = field(default_factory=list)
    catalog_error: str | None = None


def run_build(spark: SparkSession, products_dir: str, classifications_dir: str, out_dir: str,
              row_tags=None, database: str | None = None, fallback_unit_first: bool = False,
              sort: bool = True) -> BuildOutputs:
    """Full rebuild from a release folder pair into ``out_dir``.

    Raises when a source has no file or no record, when a product key is
    repeated, or when an XML file is malformed. All tables are written to a
    run folder below ``out_dir`` and checked there; only then does the folder
    become the current release, by one rename (:mod:`rxcover.sinks.releases`).
    A failed build leaves the old release as it was. Catalog tables are then
    pointed to the release's folders, all or none; a failure of the catalog is
    reported in ``catalog_error``, and the files are complete then.
    """
    out, release = out_dir.rstrip("/"), uuid.uuid4().hex
    run = f"{out}/_run-{release}"
    names = {"products": "vmp.parquet", "classifications": "bnf.parquet", "spine": "spine.parquet", "spine_csv": "spine.csv",
             "search": "search.parquet"}
    staged = {k: f"{run}/{v}" for k, v in names.items()}
    scratch = f"{out}/_scratch-{release}"
    try:
        writers.write_parquet(read_products_xml(spark, products_dir, scratch=f"{scratch}/products"), staged["products"])
        writers.write_parquet(read_classifications_xml(spark, classifications_dir, row_tags=row_tags,
                                                       scratch=f"{scratch}/classifications"), staged["classifications"])
        vmp = spark.read.parquet(staged["products"])
        bnf = spark.read.parquet(staged["classifications"])
        writers.write_parquet(build_spine(vmp, bnf, validate=True, sort=sort, fallback_unit_first=fallback_unit_first,
                                          stage=f"{scratch}/matched" if sort else None), staged["spine"])
        spine = spark.read.parquet(staged["spine"])
        writers.write_csv(spine, staged["spine_csv"])
        writers.write_parquet(lookup_index(spine), staged["search"])
        metrics = {r["metric"]: r["value"] for r in build_metrics(vmp, bnf, spine).collect()}
        units = [(r["ddd_uom"], r["n"]) for r in unit_top(bnf).collect()]
        done = BuildOutputs(**releases.publish(spark, run, out, release, names), metrics=metrics, units=units)
    finally:
        writers.remove(spark, run)
        writers.remove(spark, scratch)
    if database:
        try:
            done.tables = releases.point_tables(
                spark, {"vmp": done.products, "bnf": done.classifications, "spine": done.spine}, database)
        except Exception as e:  # noqa: BLE001  the files are the build's result
            done.catalog_error = str(e)
    if done.catalog_error is None:       # else tables may still read an older release
        releases.prune(spark, out)
    return done


def reports(spine: DataFrame, levels: int = 4, antibiotic: str = "any") -> dict[str, DataFrame]:
    """Every report of the spine as a lazy DataFrame, each reading the
    rows (nothing runs yet)."""
    prep = prepare(spine, levels=levels, antibiotic=antibiotic)
    return report_bundle(prep, antibiotics(prep, antibiotic=antibiotic))


def run_reports(spark: SparkSession, spine_path: str, out_dir: str, levels: int = 4,
                antibiotic: str = "any") -> dict[str, str]:
    """Write one Parquet table per report under ``out_dir``. ``spine_path``
    is a spine table, or the output folder of a build, whose current release
    is read.

    The spine is scanned once: its prepared rows are counted per
    combination of the columns the reports group and filter on (the count
    cube, bounded by the code vocabulary), the cube is written to
    ``<out_dir>/_cube`` and every report is computed from it. Without the
    cube each report would scan the spine again.
    """
    out = out_dir.rstrip("/")
    prep = prepare(spark.read.parquet(releases.resolved(spark, spine_path, "spine")), levels=levels, antibiotic=antibiotic)
    writers.write_parquet(report_cube(prep), f"{out}/_cube")
    cube = spark.read.parquet(f"{out}/_cube")
    return writers.write_reports(report_bundle(cube, antibiotics(cube, antibiotic=antibiotic)), out)
