"""Display text of the reports: thousands separators and percentages.

Percentages are rounded half-to-even on the value, as the report labels do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxcover.functions.text import col_of


def comma(n: Column | str) -> Column:
    """Integer with thousands separators: 12345 -> ``12,345``."""
    return F.format_number(col_of(n), 0)


def percent(x: Column | str, decimals: int = 1) -> Column:
    """Share as percent text: 0.6662 -> ``66.6%`` (decimals=1)."""
    return F.concat(F.format_number(F.bround(col_of(x) * 100, decimals), decimals), F.lit("%"))


def count_share_label(n: Column | str, pct: Column | str) -> Column:
    """``12,345\\n(66.6%)``."""
    return F.concat(comma(n), F.lit("\n("), percent(pct, 1), F.lit(")"))


def ratio_label(pct: Column | str, part: Column | str, total: Column | str) -> Column:
    """``67%\\n(2/3)``."""
    return F.concat(percent(pct, 0), F.lit("\n("), col_of(part).cast("string"), F.lit("/"),
                    col_of(total).cast("string"), F.lit(")"))
