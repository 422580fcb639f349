"""Table operators: each takes and returns DataFrames."""

from rxcover.operators.lookup import ddd_lookup, ddd_lookup_names, ddd_search, display, page
from rxcover.operators.prepared import antibiotics, prepare
from rxcover.operators.reports import (
    abx_ddd,
    abx_ddd_labels,
    abx_gap,
    abx_gap_status,
    abx_level4,
    abx_missing,
    abx_status_long,
    abx_subclass,
    abx_subclass_total,
    coverage,
    coverage_labels,
    filter_group,
    group_coverage,
    group_gap_rate,
    report_bundle,
    report_cube,
    summary,
)
from rxcover.operators.spine import (
    DuplicateKeyError,
    apply_fallbacks,
    assert_unique,
    build_metrics,
    build_spine,
    duplicate_keys,
    join_one_to_many,
    sort_spine,
    type_and_patch,
    unit_top,
)

__all__ = [
    "ddd_lookup", "ddd_lookup_names", "ddd_search", "display", "page",
    "antibiotics", "prepare",
    "abx_ddd", "abx_ddd_labels", "abx_gap", "abx_gap_status", "abx_level4", "abx_missing",
    "abx_status_long", "abx_subclass", "abx_subclass_total", "coverage", "coverage_labels",
    "filter_group", "group_coverage", "group_gap_rate", "report_bundle", "report_cube", "summary",
    "DuplicateKeyError", "apply_fallbacks", "assert_unique", "build_metrics", "build_spine",
    "duplicate_keys", "join_one_to_many", "sort_spine", "type_and_patch", "unit_top",
]
