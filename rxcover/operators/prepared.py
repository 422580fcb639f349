"""Derived columns of the spine used by every report, and the antibiotic
subset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcover.functions.classify import (
    antibiotic_by_any,
    antibiotic_by_atc,
    antibiotic_filter,
    atc_level,
    has_code,
    j01_class,
    mapping_status,
)

PREPARED_COLUMNS = ("atc_level1_code", "atc_level2_code", "atc_level3_code", "atc_level4_code",
                    "has_bnf", "has_atc", "mapping_status", "is_antibiotic")


def prepare(spine: DataFrame, levels: int = 4, antibiotic: str = "any") -> DataFrame:
    """Spine plus ATC levels 1-4, coverage flags, mapping status and the
    antibiotic flag.

    ``levels=4`` is the four-way status (ATC + BNF, ATC only, BNF only,
    Unmapped); ``levels=3`` leaves ATC-only rows null. ``antibiotic="any"``
    flags ATC J01 or BNF 0501 with unknown as false; ``"atc"`` flags ATC J01
    only and is null when the ATC code is null.
    """
    atc, bnf = F.col("atc_code"), F.col("bnf_code")
    if antibiotic == "any":
        abx = antibiotic_by_any(atc, bnf)
    elif antibiotic == "atc":
        abx = antibiotic_by_atc(atc)
    else:
        raise ValueError("antibiotic must be 'any' or 'atc'")
    return spine.select(
        "*",
        *[atc_level(atc, n).alias(f"atc_level{n}_code") for n in (1, 2, 3, 4)],
        has_code(bnf).alias("has_bnf"),
        has_code(atc).alias("has_atc"),
    ).select("*", mapping_status("has_atc", "has_bnf", levels).alias("mapping_status"), abx.alias("is_antibiotic"))


def antibiotics(prepared: DataFrame, antibiotic: str = "any") -> DataFrame:
    """Antibiotic rows with their J01 subclass label (``Other (<code>)`` for
    codes without a label, ``Other (NA)`` for a null one).

    The filter is written on the raw code columns, so a Parquet scan gets
    ``Or(StringStartsWith, StringStartsWith)`` pushed down; the flag column
    itself wraps the OR in ``coalesce`` and would push nothing.
    """
    if "atc_code" not in prepared.columns:  # a count cube keeps only the flag
        rows = prepared.filter(F.col("is_antibiotic"))
    elif antibiotic == "any":
        rows = prepared.filter(antibiotic_filter("atc_code", "bnf_code"))
    else:
        rows = prepared.filter(antibiotic_by_atc("atc_code"))
    return rows.withColumn("j01_class", j01_class("atc_level3_code", "other"))
