"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the test tables.

Products come from ``part`` and classification records from ``lineitem``
through :mod:`rxcover.sources.tpch`, so every query's work grows with those
tables. Nothing is kept between calls: every call writes its input (the built
spine, XML, Parquet, CSV, catalog tables) to a new folder under the shared
scratch folder and reads that back, so its time includes the build.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.functions.classify import atc_group
from rxcover.functions.dose import numeric_text
from rxcover.functions.text import strip_namespace, trim_text
from rxcover.operators import lookup as lk
from rxcover.operators import prepared as pr
from rxcover.operators import reports as rp
from rxcover.operators import spine as sp
from rxcover.session import scratch_path
from rxcover.sinks import writers
from rxcover.sources import tables, tpch
from rxcover.sources import xml as xsrc
from rxcover.sources.records import CLASSIFICATION_TAGS, PRODUCT_TAGS

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered instances of parameterised operators.
GROUP_PARAMETER = "Anti-Infectives (Systemic)"
EMPTY_GROUP = "no such group"
SEARCH_TERM = "amoxiclav ring"
SEARCH_COLUMNS = {"atc_code": "j01c", "ddd_uom": "g", "ddd_mg": (0.004, 25_000.0), "ddd": "2"}
LOOKUP_PAGE = 2
ABX_MISSING_PAGE = 2
CATALOG_DATABASE = "rxcover"
# Classification records of this line number are written under a second
# record tag, in a deeper folder, to exercise multi-tag and recursive reads.
SECOND_TAG_LINE = 7


# --------------------------------------------------------------------------
# inputs

def vmp(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.products(spark, sf)


def bnf(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.classifications(spark, sf)


def spine(spark: SparkSession, sf: str, validate: bool = False, **kw) -> DataFrame:
    return sp.build_spine(vmp(spark, sf), bnf(spark, sf), validate=validate, **kw)


def spine_table(spark: SparkSession, sf: str) -> DataFrame:
    """The spine as the build writes it. Reports, the classification queries
    and the dose explorer read this table, as the report job and the dashboard
    read the built spine: scans prune columns and take pushed filters, and
    their filters are not inlined into the build's expressions (with which
    the generated code passes 64 KB)."""
    path = run_path(spark, "spine")
    writers.write_parquet(spine(spark, sf), path)
    return spark.read.parquet(path)


def prepared(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return pr.prepare(spine_table(spark, sf), **kw)


def abx(spark: SparkSession, sf: str) -> DataFrame:
    return pr.antibiotics(prepared(spark, sf))


def lookup_table(spark: SparkSession, sf: str) -> DataFrame:
    return lk.ddd_lookup(spine_table(spark, sf))


# --------------------------------------------------------------------------
# written inputs (a new folder for every call)

def run_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "runs", name, unique=True)


def xml_product_dir(spark: SparkSession, sf: str) -> str:
    path = run_path(spark, "item_24")
    raw = tpch.raw_products(tpch.read_table(spark, sf, "part"))
    xsrc.write_xml_records(raw, f"{path}/release", "VMP", "VMPS", PRODUCT_TAGS)
    return path


def xml_classification_dir(spark: SparkSession, sf: str) -> str:
    path = run_path(spark, "item_25")
    lines = tpch.read_table(spark, sf, "lineitem")
    second = F.col("l_linenumber") == SECOND_TAG_LINE
    xsrc.write_xml_records(tpch.raw_classifications(lines.filter(~second)), f"{path}/release", "VMP", "VMPS",
                           CLASSIFICATION_TAGS)
    xsrc.write_xml_records(tpch.raw_classifications(lines.filter(second)), f"{path}/extra/nested", "REC", "RECS",
                           CLASSIFICATION_TAGS)
    return path


# --------------------------------------------------------------------------
# queries: sources

def q_xml_vmp_records(spark, sf):
    return xsrc.read_products_xml(spark, xml_product_dir(spark, sf), name_glob="part-*")


def q_xml_bnf_records(spark, sf):
    return xsrc.read_classifications_xml(spark, xml_classification_dir(spark, sf), name_glob="part-*")


def _tag_text():
    k = F.col("p_partkey")
    return (F.when(k % 7 == 0, F.lit(""))
            .when(k % 3 == 0, F.col("p_name"))
            .when(k % 5 == 1, F.concat(F.lit("{urn:a}{"), F.col("p_brand"), F.lit("}"), F.col("p_type")))
            .otherwise(F.concat(F.lit("{http://example.org/"), F.col("p_brand"), F.lit("}"), F.col("p_name"))))


def q_strip_namespace(spark, sf):
    t = _tag_text()
    return tpch.read_table(spark, sf, "part").select("p_partkey", t.alias("tag_text"),
                                                     strip_namespace(t).alias("tag"))


# Padding of the trim query, by key modulo 4 (Unicode spaces).
_PADDING = {0: (" ", "  "), 1: ("\t\n", "\r\n"), 2: (" 　", " "), 3: ("\x1c", "\x85")}


def q_trim_text(spark, sf):
    k = F.col("p_partkey") % 4
    left = right = None
    for r, (lp, rp_) in _PADDING.items():
        left = F.when(k == r, F.lit(lp)) if left is None else left.when(k == r, F.lit(lp))
        right = F.when(k == r, F.lit(rp_)) if right is None else right.when(k == r, F.lit(rp_))
    padded = F.concat(left, F.col("p_name"), right)
    return tpch.read_table(spark, sf, "part").select("p_partkey", trim_text(padded).alias("trimmed"))


def q_load_status(spark, sf):
    base = sf.rstrip("/")
    return tables.load_status(spark, {
        "part": f"{base}/part.parquet",
        "lineitem": f"{base}/lineitem.parquet",
        "spine": f"{base}/spine.parquet",
    })


# --------------------------------------------------------------------------
# queries: sinks (write, then read back what was written)

def q_roundtrip_parquet(spark, sf):
    path = run_path(spark, "spine_parquet")
    writers.write_parquet(spine(spark, sf), path)
    return spark.read.parquet(path)


def csv_rows(spark, sf):
    """The spine with product names that need quoting."""
    k = F.ascii(F.substring("vpid", -1, 1)) % 8
    name = F.col("vmp_nm")
    odd = (F.when(k == 0, F.concat(F.lit('a "quoted", '), name)).when(k == 1, F.concat(name, F.lit("\nnext line")))
           .when(k == 2, F.concat(F.lit("  "), name, F.lit(" "))).when(k == 3, F.concat(name, F.lit("\\")))
           .when(k == 4, F.concat(F.lit('"'), name)).when(k == 5, F.concat(name, F.lit("\r\nx"))).otherwise(name))
    return spine(spark, sf).withColumn("vmp_nm", odd)


def q_roundtrip_csv(spark, sf):
    path = run_path(spark, "spine_csv")
    rows = csv_rows(spark, sf)
    writers.write_csv(rows, path)
    return writers.read_csv(spark, path, rows.schema)


def q_catalog_tables(spark, sf):
    database = f"{CATALOG_DATABASE}_{uuid.uuid4().hex}"
    names = writers.save_tables(
        spark, {"vmp": vmp(spark, sf), "bnf": bnf(spark, sf), "spine": spine(spark, sf)}, database,
        location=run_path(spark, "catalog"))
    return spark.table(names["spine"])


def report_lines(df: DataFrame, report: str) -> DataFrame:
    """Each row of a report as one line of text, columns in order of name;
    shares in millionths, so that two engines print them alike."""
    parts = []
    for c, kind in sorted(df.dtypes):
        x = F.round(F.col(c) * 1_000_000).cast("bigint") if kind == "double" else F.col(c)
        parts.append(F.concat(F.lit(f"{c}="), F.coalesce(x.cast("string"), F.lit("-"))))
    return df.select(F.lit(report).alias("report"), F.concat_ws(";", *parts).alias("line"))


def q_write_reports(spark, sf):
    root = run_path(spark, "reports")
    cube = f"{root}/_cube"
    writers.write_parquet(rp.report_cube(prepared(spark, sf)), cube)
    rows = spark.read.parquet(cube)
    writers.write_reports(rp.report_bundle(rows, pr.antibiotics(rows)), root)
    out = None
    for name in rp.REPORT_NAMES:
        part = report_lines(spark.read.parquet(f"{root}/{name}"), name)
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------
# queries: build

def q_spine(spark, sf):
    return spine(spark, sf, validate=True)


def q_spine_sorted(spark, sf):
    return spine(spark, sf, sort=True, stage=run_path(spark, "matched"))


def q_spine_unit_first(spark, sf):
    return spine(spark, sf, fallback_unit_first=True)


def q_duplicate_keys(spark, sf):
    return sp.duplicate_keys(bnf(spark, sf), "vpid")


def q_uom_resolve(spark, sf):
    return bnf(spark, sf)


def q_ddd_numeric(spark, sf):
    return bnf(spark, sf).select("vpid", F.col("ddd").alias("ddd_text"), numeric_text("ddd").alias("ddd"))


def q_uom_default(spark, sf):
    return spine(spark, sf).groupBy("ddd_uom").agg(F.count(F.lit(1)).alias("n"))


def q_ddd_fallback(spark, sf):
    joined = sp.join_one_to_many(vmp(spark, sf), sp.parse_dose(bnf(spark, sf)), "vpid")
    patched = sp.type_and_patch(joined, rule_column="fallback_rule")
    return (patched.filter(F.col("fallback_rule").isNotNull())
            .select("vpid", "vmp_nm", "bnf_code", "atc_code", "ddd", "ddd_uom", "fallback_rule"))


def q_ddd_to_mg(spark, sf):
    return spine(spark, sf).groupBy("ddd_uom").agg(
        F.count("ddd").alias("n_ddd"), F.count("ddd_mg").alias("n_mg"),
        F.min("ddd_mg").alias("min_mg"), F.max("ddd_mg").alias("max_mg"))


def q_uom_top10(spark, sf):
    return sp.unit_top(bnf(spark, sf), 10)


def q_build_metrics(spark, sf):
    v, b = vmp(spark, sf), bnf(spark, sf)
    return sp.build_metrics(v, b, sp.build_spine(v, b, validate=False))


# --------------------------------------------------------------------------
# queries: classification

def q_prepared(spark, sf):
    return prepared(spark, sf)


def q_atc_levels(spark, sf):
    return prepared(spark, sf).groupBy(
        "atc_code", "atc_level1_code", "atc_level2_code", "atc_level3_code", "atc_level4_code"
    ).agg(F.count(F.lit(1)).alias("n"))


def q_coverage_flags(spark, sf):
    return prepared(spark, sf).groupBy("has_bnf", "has_atc").agg(F.count(F.lit(1)).alias("n"))


def q_mapping_status3(spark, sf):
    return prepared(spark, sf, levels=3).groupBy("mapping_status").agg(F.count(F.lit(1)).alias("n"))


def q_mapping_status4(spark, sf):
    return prepared(spark, sf, levels=4).groupBy("mapping_status").agg(F.count(F.lit(1)).alias("n"))


def q_antibiotic_atc(spark, sf):
    return prepared(spark, sf, antibiotic="atc").groupBy("is_antibiotic").agg(F.count(F.lit(1)).alias("n"))


def q_antibiotic_any(spark, sf):
    return prepared(spark, sf).groupBy("is_antibiotic").agg(F.count(F.lit(1)).alias("n"))


def q_antibiotics(spark, sf):
    return abx(spark, sf)


def q_atc_group_labels(spark, sf):
    p = prepared(spark, sf)
    return p.groupBy("atc_level1_code").agg(F.count(F.lit(1)).alias("n")).select(
        "atc_level1_code", "n",
        atc_group("atc_level1_code", "other").alias("group_other"),
        atc_group("atc_level1_code", "code").alias("group_code"))


# --------------------------------------------------------------------------
# queries: reports

def q_coverage(spark, sf):
    return rp.coverage(prepared(spark, sf))


def q_coverage_labels(spark, sf):
    return rp.coverage_labels(prepared(spark, sf))


def q_group_filter(spark, sf):
    return rp.coverage(prepared(spark, sf), group=GROUP_PARAMETER)


def q_group_filter_empty(spark, sf):
    """A group that no row has: the report is empty, it does not fail."""
    return rp.coverage_labels(prepared(spark, sf), group=EMPTY_GROUP)


def q_group_coverage(spark, sf):
    return rp.group_coverage(prepared(spark, sf))


def q_group_gap_rate(spark, sf):
    return rp.group_gap_rate(prepared(spark, sf))


def q_abx_subclass(spark, sf):
    return rp.abx_subclass(abx(spark, sf))


def q_abx_subclass_total(spark, sf):
    return rp.abx_subclass_total(abx(spark, sf))


def q_abx_level4(spark, sf):
    return rp.abx_level4(abx(spark, sf))


def q_abx_ddd(spark, sf):
    return rp.abx_ddd(abx(spark, sf))


def q_abx_ddd_labels(spark, sf):
    return rp.abx_ddd_labels(abx(spark, sf))


def q_abx_gap(spark, sf):
    return rp.abx_gap(abx(spark, sf))


def q_abx_gap_status(spark, sf):
    return rp.abx_gap_status(abx(spark, sf))


def q_abx_status_long(spark, sf):
    return rp.abx_status_long(abx(spark, sf))


def q_summary(spark, sf):
    return rp.summary(prepared(spark, sf))


def q_abx_missing(spark, sf):
    return rp.abx_missing(abx(spark, sf))


# --------------------------------------------------------------------------
# queries: dose explorer

def q_ddd_lookup(spark, sf):
    return lookup_table(spark, sf)


def q_ddd_lookup_names(spark, sf):
    return lk.ddd_lookup_names(spine_table(spark, sf))


def q_ddd_search(spark, sf):
    return lk.lookup_search(spine_table(spark, sf), term=SEARCH_TERM)


def q_ddd_search_columns(spark, sf):
    return lk.lookup_search(spine_table(spark, sf), column_terms=SEARCH_COLUMNS)


def q_ddd_search_indexed(spark, sf):
    """The search and the column filters through a stored index."""
    table = spine_table(spark, sf)
    path = run_path(spark, "search")
    writers.write_parquet(lk.lookup_index(table), path)
    index = spark.read.parquet(path)
    return (lk.lookup_search(table, term=SEARCH_TERM, index=index)
            .unionByName(lk.lookup_search(table, column_terms=SEARCH_COLUMNS, index=index)))


def q_page_of_table(spark, sf):
    return lk.lookup_page(spine_table(spark, sf), LOOKUP_PAGE, codes.DDD_LOOKUP_PAGE_SIZE)


def q_report_cube(spark, sf):
    return rp.report_cube(prepared(spark, sf))


def q_abx_missing_page(spark, sf):
    """Page 2 of the unmapped-antibiotic table (10 rows) in the table's order
    (name, nulls last), ties broken by the remaining columns; rows equal in
    every column are identical, so the page content is fixed."""
    rows = rp.abx_missing(abx(spark, sf), display_names=False)
    order = [F.col("vmp_nm").asc_nulls_last(), F.col("vpid"), F.col("bnf_code").asc_nulls_last(),
             F.col("mapping_status").asc_nulls_last()]
    return lk.display(lk.page(rows, ABX_MISSING_PAGE, codes.ABX_MISSING_PAGE_SIZE, order), codes.ABX_MISSING_HEADERS)


def q_ddd_lookup_display(spark, sf):
    return lk.display(lookup_table(spark, sf), codes.DDD_LOOKUP_HEADERS)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
