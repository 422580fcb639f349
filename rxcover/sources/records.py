"""Shape of the two record sets, shared by every source.

A source yields the child texts of each record as strings (``""`` for an
absent child). These functions trim them and resolve the unit, producing

* products (``vmp``): vpid, vmp_nm, vtmid, vpid_prev
* classifications (``bnf``): vpid, bnf_code, atc_code, ddd, ddd_uom

All columns are strings and never null; ``ddd`` is still text here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rxcover.functions.dose import resolve_unit
from rxcover.functions.text import text_or_empty

PRODUCT_COLUMNS = ("vpid", "vmp_nm", "vtmid", "vpid_prev")
CLASSIFICATION_COLUMNS = ("vpid", "bnf_code", "atc_code", "ddd", "ddd_uom")
# Raw classification children before the unit is resolved.
RAW_CLASSIFICATION_COLUMNS = ("vpid", "bnf_code", "atc_code", "ddd", "ddd_uomcd", "ddd_uom")

# Child element of each column.
PRODUCT_TAGS = {"vpid": "VPID", "vmp_nm": "NM", "vtmid": "VTMID", "vpid_prev": "VPIDPREV"}
CLASSIFICATION_TAGS = {"vpid": "VPID", "bnf_code": "BNF_CODE", "atc_code": "ATC", "ddd": "DDD",
                       "ddd_uomcd": "DDD_UOMCD", "ddd_uom": "DDD_UOM"}


def product_records(raw: DataFrame) -> DataFrame:
    """Trimmed product records from raw child texts."""
    return raw.select(*[text_or_empty(c).alias(c) for c in PRODUCT_COLUMNS])


def classification_records(raw: DataFrame) -> DataFrame:
    """Trimmed classification records; the unit is the unit code if there is
    one, else the unit text, translated through the unit code table.

    Trimming is projected first: the unit resolution reads each trimmed
    value more than once, and Catalyst keeps a projection whose non-trivial
    columns are read repeatedly instead of inlining them into every branch.
    """
    trimmed = raw.select(*[text_or_empty(c).alias(c) for c in RAW_CLASSIFICATION_COLUMNS])
    return trimmed.select(
        "vpid", "bnf_code", "atc_code", "ddd",
        resolve_unit("ddd_uomcd", "ddd_uom").alias("ddd_uom"),
    )
