"""The spine: products left-joined to their classification records, typed,
unit-defaulted, patched by the fallback rules and converted to mg.

Plan shape
----------
``products LEFT JOIN classifications`` is written as

    classifications INNER JOIN products            (matched rows)
    UNION ALL products LEFT ANTI JOIN keys(classifications)

which returns exactly the left join's rows. The point is skew: one product
may own a large share of all classification records. For an outer join,
adaptive execution can split skewed partitions only on the preserved side,
so a hot key on the classification side would land in one task. An inner
join can be split on either side, and the anti join's right side is the
distinct key set, aggregated map-side before it is shuffled. When the
products side is under the broadcast threshold (Spark checks its size from
statistics, and adaptive execution re-checks it at run time), the inner
join streams the classification records with no shuffle at all.

Lazily, the anti join scans the key column of the classifications a second
time, and a global sort computes its input once more to choose its ranges.
With a ``stage`` folder the matched rows are written once, finished; the
anti join and the sort read that table, so the classification records are
scanned, joined and parsed once however the result is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.functions.dose import default_unit, finite_or_infinite, number_of, numeric_text, to_mg, unit_key
from rxcover.functions.text import trim_text
from rxcover.operators.order import spread_order

SPINE_COLUMNS = ("vpid", "vmp_nm", "vtmid", "vpid_prev", "bnf_code", "atc_code", "ddd", "ddd_uom", "ddd_mg")


class DuplicateKeyError(ValueError):
    """The left side of a one-to-many join has a repeated key."""


def duplicate_keys(df: DataFrame, key: str = "vpid") -> DataFrame:
    """Keys that occur more than once, with their count ``n``. Partial
    aggregation collapses a hot key map-side before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str = "vpid") -> None:
    """Raise if ``key`` is repeated in ``df`` (one job, key column only)."""
    dup = duplicate_keys(df.select(key), key).limit(5).collect()
    if dup:
        shown = ", ".join(f"{r[key]!r} x{r['n']}" for r in dup)
        raise DuplicateKeyError(f"left side of one-to-many join has repeated {key}: {shown}")


def join_one_to_many(left: DataFrame, right: DataFrame, key: str = "vpid") -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a left side with unique keys,
    in the skew-splittable form described in the module docstring."""
    return matched_rows(left, right, key).unionByName(unmatched_rows(left, right, right.select(key), key))


def matched_rows(left: DataFrame, right: DataFrame, key: str = "vpid") -> DataFrame:
    """The rows of the left join that have a right side."""
    return right.join(left, key, "inner").select(*left.columns, *[c for c in right.columns if c != key])


def unmatched_rows(left: DataFrame, right: DataFrame, keys: DataFrame, key: str = "vpid") -> DataFrame:
    """The rows of ``left`` whose key is not in ``keys`` (repeats allowed),
    with nulls for the other columns of ``right``."""
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    return left.join(keys.distinct(), key, "left_anti").select(*left.columns, *absent)


def fallback_rule(name: Column, ddd: Column, rules=codes.FALLBACK_RULES) -> Column:
    """Index of the first rule whose fragment is in the lower-cased name,
    for rows whose dose is missing; null otherwise."""
    lname = F.lower(name)
    missing = ddd.isNull() | F.isnan(ddd)
    out = None
    for i, (frag, _, _, _) in enumerate(rules):
        cond = missing & lname.contains(frag)
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def _by_rule(rule: Column, rules, pos: int) -> Column:
    out = None
    for i, r in enumerate(rules):
        out = F.when(rule == i, F.lit(r[pos])) if out is None else out.when(rule == i, F.lit(r[pos]))
    return out


def apply_fallbacks(df: DataFrame, rules=codes.FALLBACK_RULES, rule_column: str | None = None,
                    unit_missing: Column | None = None) -> DataFrame:
    """Patch missing doses from the rules. All three patches read the dose
    as it was before patching, so the first matching rule wins. The ATC code
    is patched only where it is null (an empty code stays); the unit only
    where ``unit_missing`` holds (default: unit is null)."""
    um = F.col("ddd_uom").isNull() if unit_missing is None else unit_missing
    ruled = df.select("*", fallback_rule(F.col("vmp_nm"), F.col("ddd"), rules).alias("_rule"),
                      um.alias("_um"))
    rule = F.col("_rule")
    hit = rule.isNotNull()
    patch = {
        "ddd": F.when(hit, _by_rule(rule, rules, 1)).otherwise(F.col("ddd")),
        "ddd_uom": F.when(hit & F.col("_um"), _by_rule(rule, rules, 2)).otherwise(F.col("ddd_uom")),
        "atc_code": F.when(hit & F.col("atc_code").isNull(), _by_rule(rule, rules, 3))
                     .otherwise(F.col("atc_code")),
    }
    cols = [patch[c].alias(c) if c in patch else F.col(c) for c in df.columns]
    if rule_column:
        cols.append(F.when(hit, _by_rule(rule, rules, 0)).alias(rule_column))
    return ruled.select(*cols)


def type_and_patch(joined: DataFrame, fallback_unit_first: bool = False,
                   rule_column: str | None = None) -> DataFrame:
    """Typing, unit default, fallbacks and mg conversion of a joined table.

    Default order (unit default, then fallbacks) means a patched product
    with no unit keeps ``mg``; ``fallback_unit_first=True`` lets the rule's
    unit fill a missing (null or empty) unit first.
    """
    types = dict(joined.dtypes)
    typed = {"vpid": F.col("vpid").cast("string"), "vtmid": F.col("vtmid").cast("string")}
    if types["ddd"] == "string":
        typed["ddd"] = numeric_text("ddd")
    has_unit = "ddd_uom" in types
    if has_unit and not fallback_unit_first:
        typed["ddd_uom"] = default_unit("ddd_uom")
    df = joined.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in joined.columns])
    if has_unit and not fallback_unit_first:
        df = apply_fallbacks(df, rule_column=rule_column)
    elif has_unit:
        missing = F.col("ddd_uom").isNull() | (F.col("ddd_uom") == "")
        df = apply_fallbacks(df, rule_column=rule_column, unit_missing=missing)
        df = df.withColumn("ddd_uom", default_unit("ddd_uom"))
    else:
        df = apply_fallbacks(df, rule_column=rule_column, unit_missing=F.lit(False))
    if has_unit:
        # The unit key is projected once; Catalyst keeps the projection
        # because the conversion reads it in every branch.
        cols = df.columns
        df = (df.select("*", unit_key("ddd_uom").alias("_unit_key"))
              .select(*cols, to_mg("ddd", "_unit_key", unit_is_key=True).alias("ddd_mg")))
    return df


def parse_dose(bnf: DataFrame) -> DataFrame:
    """Classification records with the dose text parsed to double. The
    trimmed text and its value are projected once, so the regex runs once
    per row although the final expression reads them in several branches."""
    if dict(bnf.dtypes).get("ddd") != "string":
        return bnf
    keep = [c for c in bnf.columns if c != "ddd"]
    return (bnf.select(*keep, trim_text("ddd").alias("_ddd_text"))
            .select(*keep, "_ddd_text", number_of("_ddd_text").alias("_ddd_value"))
            .select(*[finite_or_infinite("_ddd_value", "_ddd_text").alias("ddd") if c == "ddd" else F.col(c)
                      for c in bnf.columns]))


def sort_spine(spine: DataFrame) -> DataFrame:
    """Deterministic order: by ``vpid`` as text, remaining columns as
    tie-breaks (several rows share a vpid).

    Every column is in the order, so a hot ``vpid`` is split (see
    :func:`rxcover.operators.order.spread_order`).
    """
    cols = spine.columns
    order = [F.col("vpid").asc()] + [F.col(c).asc_nulls_first() for c in cols if c != "vpid"]
    return spread_order(spine, order)


def build_spine(vmp: DataFrame, bnf: DataFrame, validate: bool = True, sort: bool = False,
                fallback_unit_first: bool = False, stage: str | None = None) -> DataFrame:
    """Products joined to classification records, typed and patched.

    ``validate`` raises :class:`DuplicateKeyError` when a product key is
    repeated (one job over the key column). ``sort`` adds the global order.
    ``stage`` names a folder on shared storage for the matched rows (see the
    module docstring); it must outlive the returned DataFrame. Without it the
    result is one lazy plan.
    """
    if validate:
        assert_unique(vmp, "vpid")
    # The dose is parsed before the join (unmatched rows get null either
    # way). Filters on derived columns are pushed below the projections
    # above the join with every alias inlined; parsing here keeps the text
    # parsing out of those inlined expressions.
    bnf = parse_dose(bnf)

    def finished(joined: DataFrame) -> DataFrame:
        typed = type_and_patch(joined, fallback_unit_first)
        return typed.select(*[c for c in SPINE_COLUMNS if c in typed.columns])

    if stage is None:
        spine = finished(join_one_to_many(vmp, bnf, "vpid"))
    else:
        if vmp.schema["vpid"].dataType != bnf.schema["vpid"].dataType:
            raise ValueError("a staged build needs vpid of one type in both tables")
        matched = finished(matched_rows(vmp, bnf))
        matched.write.mode("overwrite").parquet(stage)
        matched = matched.sparkSession.read.schema(matched.schema).parquet(stage)
        keys = matched.select(F.col("vpid").cast(bnf.schema["vpid"].dataType).alias("vpid"))
        spine = matched.unionByName(finished(unmatched_rows(vmp, bnf, keys)))
    return sort_spine(spine) if sort else spine


def build_metrics(vmp: DataFrame, bnf: DataFrame, spine: DataFrame) -> DataFrame:
    """Row counts printed by the build, in long form (metric, value):
    products parsed, classification records parsed, spine rows, spine rows
    with a non-null ATC code (``""`` counts) and with a non-empty one."""
    atc = F.col("atc_code")
    spine_counts = spine.agg(
        F.count(F.lit(1)).alias("spine_rows"),
        F.count(atc).alias("non_null_atc"),
        F.count_if(atc.isNotNull() & (atc != "")).alias("with_atc"),
    ).unpivot([], ["spine_rows", "non_null_atc", "with_atc"], "metric", "value")
    return (vmp.agg(F.count(F.lit(1)).alias("value")).select(F.lit("vmp_rows").alias("metric"), "value")
            .unionByName(bnf.agg(F.count(F.lit(1)).alias("value"))
                         .select(F.lit("bnf_rows").alias("metric"), "value"))
            .unionByName(spine_counts))


def unit_top(bnf: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent units of the classification records (null is
    a value), ties by unit."""
    return (bnf.groupBy("ddd_uom").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first("ddd_uom")).limit(k))
