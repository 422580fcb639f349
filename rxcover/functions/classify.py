"""Classification expressions: ATC levels, coverage flags, mapping status,
antibiotic flags and group labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.functions.dose import lookup
from rxcover.functions.text import col_of


def atc_level(c: Column | str, level: int) -> Column:
    """ATC prefix of ``level`` (1..4); null stays null, ``""`` stays ``""``."""
    return F.substring(col_of(c), 1, codes.ATC_LEVEL_LENGTHS[level])


def has_code(c: Column | str) -> Column:
    """Not null and not empty; never null itself."""
    x = col_of(c)
    return x.isNotNull() & (x != "")


def mapping_status(has_atc: Column | str, has_bnf: Column | str, levels: int = 4) -> Column:
    """Four-way status, or the three-way one that leaves ATC-only rows null."""
    a, b = col_of(has_atc), col_of(has_bnf)
    out = F.when(a & b, codes.STATUS_BOTH).when(b & ~a, codes.STATUS_BNF_ONLY)
    if levels == 4:
        out = out.when(a & ~b, codes.STATUS_ATC_ONLY)
    elif levels != 3:
        raise ValueError("levels must be 3 or 4")
    return out.when(~b & ~a, codes.STATUS_UNMAPPED)


def status_rank(status: Column | str, levels: int = 4) -> Column:
    """Position of a status in the display order (factor level)."""
    order = codes.STATUS_LEVELS_4 if levels == 4 else codes.STATUS_LEVELS_3
    return lookup({s: str(i) for i, s in enumerate(order)}, status).cast("int")


def antibiotic_by_atc(atc: Column | str) -> Column:
    """ATC starts with J01; null when the ATC code is null."""
    return col_of(atc).startswith(codes.ANTIBIOTIC_ATC_PREFIX)


def antibiotic_by_any(atc: Column | str, bnf: Column | str) -> Column:
    """ATC J01 or BNF 0501, with unknown as false."""
    return F.coalesce(antibiotic_filter(atc, bnf), F.lit(False))


def antibiotic_filter(atc: Column | str, bnf: Column | str) -> Column:
    """The bare three-valued OR; used in filters because the parquet reader
    takes it as ``Or(StringStartsWith, StringStartsWith)``."""
    return (col_of(atc).startswith(codes.ANTIBIOTIC_ATC_PREFIX)
            | col_of(bnf).startswith(codes.ANTIBIOTIC_BNF_PREFIX))


def labelled(mapping: dict[str, str], code: Column | str, unknown: str = "other") -> Column:
    """Label of a code. ``unknown="other"`` gives ``Other (<code>)`` (a null
    code prints as NA); ``unknown="code"`` falls through to the code."""
    c = col_of(code)
    label = lookup(mapping, c)
    if unknown == "code":
        return F.coalesce(label, c)
    if unknown == "other":
        return F.coalesce(label, F.concat(F.lit("Other ("), F.coalesce(c, F.lit("NA")), F.lit(")")))
    raise ValueError("unknown must be 'other' or 'code'")


def atc_group(level1: Column | str, unknown: str = "other") -> Column:
    return labelled(codes.ATC_GROUP_LABELS, level1, unknown)


def j01_class(level3: Column | str, unknown: str = "other") -> Column:
    return labelled(codes.J01_SUBCLASS_LABELS, level3, unknown)


def group_codes(label: str) -> list[str]:
    """Level-1 codes whose label is ``label`` (driver-side, over the fixed
    14-entry table)."""
    return [k for k, v in codes.ATC_GROUP_LABELS.items() if v == label]
