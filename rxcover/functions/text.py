"""Text column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (derived from str.isspace, 29
# code points); Spark's trim() removes only U+0020. btrim with an explicit
# set compiles to a few lines of generated code, where a regex replace
# would add a matcher block at every place the column is inlined.
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_text(c: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace; null stays null.

    Every character of the set is at most U+0020 or at least U+0085, so the
    trim runs only when the first or last code point is outside the plain
    printable ASCII range; most values skip it (an empty value takes the
    trim and stays empty).
    """
    x = col_of(c)
    first, last = F.ascii(x), F.ascii(F.substring(x, -1, 1))
    edge = (first <= 32) | (first >= 127) | (last <= 32) | (last >= 127)
    return F.when(edge, F.btrim(x, F.lit(WHITESPACE))).otherwise(x)


def strip_namespace(c: Column | str) -> Column:
    """``{uri}tag`` -> ``tag``: the text after the last ``}``, else all of it."""
    return F.substring_index(col_of(c), "}", -1)


def text_or_empty(c: Column | str) -> Column:
    """Trimmed text, with null (absent element) as ``""``."""
    return F.coalesce(trim_text(c), F.lit(""))


def first_text(c: Column | str) -> Column:
    """First element of a repeated XML child read as ``array<string>``,
    trimmed; an absent or empty child gives ``""``."""
    return text_or_empty(F.try_element_at(col_of(c), F.lit(1)))


def contains_ci(c: Column | str, term: str) -> Column:
    """Case-insensitive literal substring test."""
    return F.lower(col_of(c)).contains(term.lower())
