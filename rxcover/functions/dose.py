"""Dose and unit expressions: unit code resolution, numeric parsing,
unit default and conversion to milligrams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.functions.text import col_of, trim_text

# Text accepted as a finite number: optional sign, digits with an optional
# point (or a leading point), optional exponent, i.e.
#     ^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$
# Anything else is missing, so "1.0d", "1_000", "0x1p3" or "n/a" give null
# although a plain cast parses some of them. The check is done without a
# regex: text made only of these characters is exactly the text the cast
# accepts in that form, and the cast rejects the rest (null).
_NUMBER_CHARS = "0123456789.+-eE"
_POS_INF = float("inf")
_INF_TEXT = ("inf", "+inf", "infinity", "+infinity")
_NEG_INF_TEXT = ("-inf", "-infinity")


def _sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(mapping: dict[str, str]) -> Column:
    """A constant ``map<string,string>``; lookups on it need no join. Built
    as one SQL literal (one call to the JVM instead of one per entry)."""
    return F.expr("map(" + ", ".join(_sql_string(x) for kv in mapping.items() for x in kv) + ")")


def lookup(mapping: dict[str, str], key: Column | str) -> Column:
    """Value for ``key`` in a constant map; null when absent or null."""
    return F.try_element_at(map_literal(mapping), col_of(key))


def resolve_unit(unit_code: Column | str, unit_text: Column | str) -> Column:
    """First non-empty of the unit code and the unit text, then the code
    translated to its unit (unknown values fall through unchanged)."""
    code, text = col_of(unit_code), col_of(unit_text)
    raw = F.when(F.coalesce(code, F.lit("")) != "", code).otherwise(text)
    return F.coalesce(lookup(codes.UNIT_CODES, raw), raw)


def numeric_text(c: Column | str) -> Column:
    """Text -> double; text that is not a number gives null. Overflow and
    NaN give null, spelled-out infinity gives infinity."""
    t = trim_text(c)
    return finite_or_infinite(number_of(t), t)


def number_of(trimmed: Column | str) -> Column:
    """The value of trimmed text that is a finite-looking number, else null."""
    t = col_of(trimmed)
    return F.when(F.translate(t, _NUMBER_CHARS, "") == "", t.try_cast("double"))


def finite_or_infinite(value: Column | str, trimmed: Column | str) -> Column:
    """``value`` when finite (overflow gives null); spelled-out infinity
    from the trimmed text."""
    v, lt = col_of(value), F.lower(col_of(trimmed))
    return (F.when(F.abs(v) < F.lit(_POS_INF), v)
            .when(lt.isin(*_INF_TEXT), F.lit(_POS_INF))
            .when(lt.isin(*_NEG_INF_TEXT), F.lit(-_POS_INF)))


def default_unit(c: Column | str, default: str = codes.DEFAULT_UNIT) -> Column:
    """Empty or null unit -> ``default``."""
    return F.coalesce(F.nullif(col_of(c), F.lit("")), F.lit(default))


def unit_key(unit: Column | str) -> Column:
    """Trimmed, lower-cased unit: the key of ``codes.MG_CONVERSIONS``."""
    return F.lower(trim_text(unit))


def to_mg(value: Column | str, unit: Column | str, unit_is_key: bool = False) -> Column:
    """Dose in milligrams for mass units, null for any other unit or a
    missing dose. Multiplies or divides exactly as listed in
    ``codes.MG_CONVERSIONS`` so results agree bit for bit.

    The unit is compared once per branch; pass ``unit_is_key=True`` with a
    column that already holds :func:`unit_key` (projected beforehand) so the
    trimming is not repeated in every branch.
    """
    v = col_of(value)
    u = col_of(unit) if unit_is_key else unit_key(unit)
    out = None
    for name, (op, factor) in codes.MG_CONVERSIONS.items():
        conv = v * F.lit(factor) if op == "*" else v / F.lit(factor)
        out = F.when(u == name, conv) if out is None else out.when(u == name, conv)
    return F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double")).otherwise(out)
