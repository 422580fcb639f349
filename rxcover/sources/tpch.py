"""Adapter from the TPC-H-style test tables to the two record sets.

The test tables hold no medicines, nulls or empty strings, so products are
derived from ``part`` and classification records from ``lineitem`` with
arithmetic on their keys, chosen to reach every branch of the operators
(unmatched products, empty codes, text doses, every unit, fallback names).
The data is synthetic and says nothing about real medicines.

Both derivations are narrow projections: they scale with the input tables
and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover.sources.records import classification_records, product_records

# Synthetic name prefixes that hit the fallback rules.
_NAME_PREFIXES = {0: "Co-Amoxiclav ", 1: "Co-fluampicil ", 2: "Piperacillin / Tazobactam "}
# Letters used to synthesise ATC codes.
_J01_LEVEL3_LETTERS = "ABCDEFGMRXZ"
_J01_LEVEL4_LETTERS = "AEFR"
_OTHER_GROUP_LETTERS = "ABCDGHJLMNPRSVQ"
# Unit code and unit text by supplier key modulo 9.
_UNIT_CODES = {0: "258684004", 1: "258682000", 2: "258685003", 3: "258774008", 4: "396186001"}
_UNIT_TEXTS = {5: " G ", 6: "kg", 7: "µg", 0: "ignored"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _by_mod(key: Column, mod: int, values: dict[int, str], default: Column | str) -> Column:
    r = key % mod
    out = None
    for k, v in values.items():
        out = F.when(r == k, F.lit(v)) if out is None else out.when(r == k, F.lit(v))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def _letter(letters: str, key: Column) -> Column:
    return F.substring(F.lit(letters), (F.lit(1) + key % len(letters)).cast("int"), F.lit(1))


def raw_products(part: DataFrame) -> DataFrame:
    """Raw product child texts from ``part``."""
    k = F.col("p_partkey")
    name = F.col("p_name")
    r = k % 40
    vmp_nm = F.when(r == 3, F.lit(""))
    for key, prefix in _NAME_PREFIXES.items():
        vmp_nm = vmp_nm.when(r == key, F.concat(F.lit(prefix), name))
    return part.select(
        k.cast("string").alias("vpid"),
        vmp_nm.otherwise(name).alias("vmp_nm"),
        F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_size").cast("string")).alias("vtmid"),
        F.when(k % 10 == 1, (k - 1).cast("string")).otherwise(F.lit("")).alias("vpid_prev"),
    )


def raw_classifications(lineitem: DataFrame) -> DataFrame:
    """Raw classification child texts from ``lineitem``, one record a row.
    Records of parts with a key divisible by 7 get a key that no product
    has: those products stay unmatched, and the records match nothing."""
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    line2 = F.lpad(ln.cast("string"), 2, "0")
    s5, s6 = sk % 5, sk % 6
    bnf = (F.when(s5 == 0, F.lit(""))
           .when((s5 == 1) | (s5 == 2), F.concat(F.lit("0501"), line2))
           .otherwise(F.concat(F.lit("0407"), line2)))
    j01 = F.concat(F.lit("J01"), _letter(_J01_LEVEL3_LETTERS, pk), _letter(_J01_LEVEL4_LETTERS, sk),
                   F.lpad((sk % 20).cast("string"), 2, "0"))
    other = F.concat(_letter(_OTHER_GROUP_LETTERS, pk), F.lit("02BE01"))
    atc = F.when(s6 == 0, F.lit("")).when((s6 == 1) | (s6 == 2), j01).otherwise(other)
    ddd = (F.when(ln == 1, F.lit("")).when(ln == 2, F.lit("n/a"))
           .otherwise(F.col("l_quantity").cast("int").cast("string")))
    vpid = pk.cast("string")
    return lineitem.select(
        F.when(pk % 7 == 0, F.concat(F.lit("X"), vpid)).otherwise(vpid).alias("vpid"),
        bnf.alias("bnf_code"),
        atc.alias("atc_code"),
        ddd.alias("ddd"),
        _by_mod(sk, 9, _UNIT_CODES, "").alias("ddd_uomcd"),
        _by_mod(sk, 9, _UNIT_TEXTS, "").alias("ddd_uom"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records (``vmp``) derived from ``part``."""
    return product_records(raw_products(read_table(spark, sf_dir, "part")))


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification records (``bnf``) derived from ``lineitem``."""
    return classification_records(raw_classifications(read_table(spark, sf_dir, "lineitem")))
