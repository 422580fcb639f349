"""Column expressions built from ``pyspark.sql.functions`` only."""

from rxcover.functions.classify import (
    antibiotic_by_any,
    antibiotic_by_atc,
    antibiotic_filter,
    atc_group,
    atc_level,
    group_codes,
    has_code,
    j01_class,
    labelled,
    mapping_status,
    status_rank,
)
from rxcover.functions.dose import default_unit, lookup, numeric_text, resolve_unit, to_mg
from rxcover.functions.labels import comma, count_share_label, percent, ratio_label
from rxcover.functions.text import contains_ci, first_text, strip_namespace, text_or_empty, trim_text

__all__ = [
    "antibiotic_by_any", "antibiotic_by_atc", "antibiotic_filter", "atc_group", "atc_level",
    "group_codes", "has_code", "j01_class", "labelled", "mapping_status", "status_rank",
    "default_unit", "lookup", "numeric_text", "resolve_unit", "to_mg",
    "comma", "count_share_label", "percent", "ratio_label",
    "contains_ci", "first_text", "strip_namespace", "text_or_empty", "trim_text",
]
