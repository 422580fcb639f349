"""Coverage reports: the data behind each chart of the batch report and the
dashboard, one DataFrame per chart.

Every report aggregates first (partial aggregation map-side, one shuffle on
the group keys) and runs its windows on the aggregated rows only: a share of
the grand total sees at most one row per status, a share within a group one
row per group and status. No window ever runs over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.functions.classify import atc_group, group_codes, j01_class, status_rank
from rxcover.functions.dose import lookup
from rxcover.functions.labels import comma, count_share_label, percent, ratio_label
from rxcover.operators.order import spread_order


# A report input is either rows (prepared spine rows) or a count cube with
# a ``_rows`` weight per combination (see ``report_cube``); counts are sums of
# the weight on a cube.
WEIGHT = "_rows"


def _n(df: DataFrame):
    return F.sum(WEIGHT) if WEIGHT in df.columns else F.count(F.lit(1))


def _n_if(df: DataFrame, cond):
    if WEIGHT in df.columns:
        return F.coalesce(F.sum(F.when(cond, F.col(WEIGHT)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")
    return F.count_if(cond)


def _total(df: DataFrame):
    return F.coalesce(_n(df), F.lit(0)).cast("bigint") if WEIGHT in df.columns else _n(df)


def share(part, total):
    """``part / total`` as a double; null when the total is zero (an empty
    report has no rows or null shares, it never fails)."""
    return F.try_divide(F.col(part).cast("double") if isinstance(part, str) else part,
                        F.col(total) if isinstance(total, str) else total)


def _share_of_total(counts: DataFrame, n: str = "n", pct: str = "pct") -> DataFrame:
    # Window over the already aggregated rows (a handful), never raw rows.
    return counts.withColumn(pct, share(n, F.sum(n).over(Window.partitionBy())))


def filter_group(prepared: DataFrame, group: str = codes.ALL_GROUPS) -> DataFrame:
    """Rows whose ATC level-1 label equals ``group``; ``"All"`` keeps every
    row. Codes without a label never match. The label is turned into its
    code(s) on the driver, so the filter is a pushed-down prefix test."""
    if group == codes.ALL_GROUPS:
        return prepared
    wanted = group_codes(group)
    if not wanted:
        return prepared.filter(F.lit(False))
    cond = None
    for code in wanted:
        c = (F.col("atc_code").startswith(code) if "atc_code" in prepared.columns
             else F.col("atc_level1_code") == code)
        cond = c if cond is None else (cond | c)
    return prepared.filter(cond)


def coverage(prepared: DataFrame, group: str = codes.ALL_GROUPS, levels: int = 4) -> DataFrame:
    """Rows per mapping status and share of all rows (status order by rank)."""
    rows = filter_group(prepared, group)
    counts = rows.groupBy("mapping_status").agg(_n(rows).alias("n"))
    return (_share_of_total(counts)
            .orderBy(status_rank("mapping_status", levels).asc_nulls_last()))


def coverage_labels(prepared: DataFrame, group: str = codes.ALL_GROUPS) -> DataFrame:
    """Coverage with the bar label ``12,345\\n(66.6%)`` and the compact
    chart's ``66.6%``."""
    return coverage(prepared, group).withColumns({"label": count_share_label("n", "pct"), "pct_label": percent("pct", 1)})


def group_coverage(prepared: DataFrame) -> DataFrame:
    """Rows with an ATC code by anatomical group and status, share within
    the group, and the group total used to order the bars."""
    counts = (prepared.filter(F.col("has_atc"))
              .withColumn("atc_group", atc_group("atc_level1_code", "other"))
              .groupBy("atc_group", "mapping_status").agg(_n(prepared).alias("n")))
    w = Window.partitionBy("atc_group")
    return (counts.withColumn("group_total", F.sum("n").over(w))
            .withColumn("pct", share("n", "group_total"))
            .orderBy(F.desc("group_total"), "atc_group", "mapping_status"))


def group_gap_rate(prepared: DataFrame, min_size: int = codes.MIN_GROUP_SIZE) -> DataFrame:
    """Share of rows without an ATC code per anatomical group, for groups of
    at least ``min_size`` rows. Rows are first restricted to a non-empty
    level-1 code, so the rate is zero by construction, as in the report. The
    label is the rate as a whole percent."""
    if "atc_code" in prepared.columns:
        atc = F.col("atc_code")
        coded = prepared.filter(atc.isNotNull() & (atc != ""))
    else:
        coded = prepared.filter(F.col("has_atc"))  # same rows: has_atc is "code present"
    return (coded
            .withColumn("atc_group", atc_group("atc_level1_code", "code"))
            .groupBy("atc_group")
            .agg(_n(coded).alias("total"), _n_if(coded, ~F.col("has_atc")).alias("unmapped"))
            .withColumn("pct_unmapped", share("unmapped", "total"))
            .filter(F.col("total") >= min_size)
            .withColumn("label", percent("pct_unmapped", 0))
            .orderBy(F.desc("pct_unmapped"), "atc_group"))


def abx_subclass(antibiotics: DataFrame) -> DataFrame:
    """Antibiotic rows by J01 subclass and status, subclass total and share."""
    counts = antibiotics.groupBy("j01_class", "mapping_status").agg(_n(antibiotics).alias("n"))
    return (counts.withColumn("total", F.sum("n").over(Window.partitionBy("j01_class")))
            .withColumn("pct", share("n", "total"))
            .orderBy("total", "j01_class", "mapping_status"))


def abx_subclass_total(antibiotics: DataFrame) -> DataFrame:
    """Antibiotic rows per J01 subclass, with the label ``1,234``."""
    return (antibiotics.groupBy("j01_class").agg(_n(antibiotics).alias("total"))
            .withColumn("label", comma("total")).orderBy("total", "j01_class"))


def abx_level4(antibiotics: DataFrame) -> DataFrame:
    """Antibiotics with an ATC code by level-4 and level-3 code; the class
    label falls through to the level-3 code; share within the class."""
    counts = (antibiotics.filter(F.col("has_atc"))
              .groupBy("atc_level4_code", "atc_level3_code").agg(_n(antibiotics).alias("n"))
              .withColumn("j01_class", j01_class("atc_level3_code", "code")))
    return (counts.withColumn("pct_within_class",
                              share("n", F.sum("n").over(Window.partitionBy("j01_class"))))
            .orderBy("j01_class", F.desc("n"), "atc_level4_code"))


def abx_ddd(antibiotics: DataFrame) -> DataFrame:
    """Dose availability per J01 subclass: rows, rows with a dose, share."""
    if "has_ddd" in antibiotics.columns:
        has_ddd = F.col("has_ddd")
    else:
        ddd = F.col("ddd")
        has_ddd = ddd.isNotNull()
        if dict(antibiotics.dtypes)["ddd"] == "string":
            has_ddd = has_ddd & (ddd != "")
    return (antibiotics.groupBy("j01_class")
            .agg(_n(antibiotics).alias("total"), _n_if(antibiotics, has_ddd).alias("with_ddd"))
            .withColumn("pct_ddd", share("with_ddd", "total"))
            .orderBy("pct_ddd", "j01_class"))


def abx_ddd_labels(antibiotics: DataFrame) -> DataFrame:
    """Dose availability with the bar label ``67%\\n(2/3)``."""
    return abx_ddd(antibiotics).withColumn("label", ratio_label("pct_ddd", "with_ddd", "total"))


def abx_gap(antibiotics: DataFrame) -> DataFrame:
    """Antibiotics mapped to ATC or missing it: count, share and label."""
    status = F.when(F.col("has_atc"), F.lit(codes.GAP_MAPPED)).otherwise(F.lit(codes.GAP_MISSING))
    counts = antibiotics.groupBy(status.alias("status")).agg(_n(antibiotics).alias("n"))
    return (_share_of_total(counts).withColumn("label", count_share_label("n", "pct"))
            .orderBy("status"))


def abx_gap_status(antibiotics: DataFrame) -> DataFrame:
    """Antibiotics without an ATC code per mapping status."""
    return (antibiotics.filter(~F.col("has_atc")).groupBy("mapping_status").agg(_n(antibiotics).alias("n"))
            .orderBy(status_rank("mapping_status").asc_nulls_last()))


def abx_status_long(antibiotics: DataFrame) -> DataFrame:
    """Antibiotic summary: fully mapped, BNF only and unmapped counts (wide,
    one aggregation), unpivoted to (status, n) with the share of all
    antibiotic rows. ATC-only rows are in the total but in no status."""
    a, b = F.col("has_atc"), F.col("has_bnf")
    wide = antibiotics.agg(
        _total(antibiotics).alias("total"),
        _n_if(antibiotics, a & b).alias("fully_mapped"),
        _n_if(antibiotics, b & ~a).alias("bnf_only"),
        _n_if(antibiotics, ~b & ~a).alias("unmapped"),
    )
    long = wide.unpivot(["total"], list(codes.ABX_STATUS_COLUMNS), "status_key", "n")
    recode = lookup(codes.ABX_STATUS_COLUMNS, "status_key")
    return (long.select("total", recode.alias("status"), "n")
            .withColumn("pct", share("n", "total"))
            .withColumn("label", percent("pct", 1))
            .orderBy(status_rank("status", 3)))


def summary(prepared: DataFrame) -> DataFrame:
    """Console summary in one row: rows, rows with BNF / ATC code and their
    percent, antibiotic rows (count of true), and the overall chart's text of
    the total."""
    return (prepared.agg(
        _total(prepared).alias("total"),
        _n_if(prepared, F.col("has_bnf")).alias("with_bnf"),
        _n_if(prepared, F.col("has_atc")).alias("with_atc"),
        _n_if(prepared, F.col("is_antibiotic")).alias("antibiotics"))
        .withColumn("pct_bnf", share("with_bnf", "total") * 100)
        .withColumn("pct_atc", share("with_atc", "total") * 100)
        .withColumn("label", F.concat(F.lit(codes.TOTAL_TEXT), comma("total")))
        .select("total", "with_bnf", "pct_bnf", "with_atc", "pct_atc", "antibiotics", "label"))


def abx_missing(antibiotics: DataFrame, display_names: bool = True) -> DataFrame:
    """Antibiotics without an ATC code: id, name, BNF code and status,
    ordered by name (nulls last), with the table's display headers."""
    cols = list(codes.ABX_MISSING_HEADERS)
    out = spread_order(antibiotics.filter(~F.col("has_atc")).select(*cols),
                       [F.asc_nulls_last("vmp_nm"), F.col("vpid"), F.asc_nulls_last("bnf_code"),
                        F.asc_nulls_last("mapping_status")])
    if display_names:
        out = out.toDF(*[codes.ABX_MISSING_HEADERS[c] for c in cols])
    return out


# Columns the bundled reports group or filter on; every bundled report can
# be computed from counts per combination of them.
CUBE_KEYS = ("atc_level1_code", "atc_level3_code", "atc_level4_code", "has_atc", "has_bnf",
             "mapping_status", "is_antibiotic", "has_ddd")


def report_cube(prepared: DataFrame) -> DataFrame:
    """Rows per combination of ``CUBE_KEYS`` (weight column ``_rows``).

    One scan of the prepared rows and one aggregation (combined map-side)
    replace a scan per report; the result is bounded by the ATC code
    vocabulary times a few flags, not by the number of rows.
    """
    return (prepared.withColumn("has_ddd", F.col("ddd").isNotNull())
            .groupBy(*CUBE_KEYS).agg(F.count(F.lit(1)).alias(WEIGHT)))


REPORT_NAMES = ("coverage", "group_coverage", "group_gap_rate", "abx_subclass", "abx_subclass_total",
                "abx_level4", "abx_ddd", "abx_status_long", "abx_gap", "abx_gap_status", "summary")


def report_bundle(prepared: DataFrame, antibiotic_rows: DataFrame) -> dict[str, DataFrame]:
    """Every chart's data, keyed by report name."""
    return {
        "coverage": coverage_labels(prepared),
        "group_coverage": group_coverage(prepared),
        "group_gap_rate": group_gap_rate(prepared),
        "abx_subclass": abx_subclass(antibiotic_rows),
        "abx_subclass_total": abx_subclass_total(antibiotic_rows),
        "abx_level4": abx_level4(antibiotic_rows),
        "abx_ddd": abx_ddd_labels(antibiotic_rows),
        "abx_status_long": abx_status_long(antibiotic_rows),
        "abx_gap": abx_gap(antibiotic_rows),
        "abx_gap_status": abx_gap_status(antibiotic_rows),
        "summary": summary(prepared),
    }
