"""Total orders that a hot key does not put into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in the given order, ties broken by the partition a row comes
    from.

    A range exchange sends equal sort keys to one partition. With every
    column in the order, a hot value is split by the other columns; for
    identical rows (copies) the last tie-break is the partition the row
    comes from, so copies spread over many input partitions are split too.
    That value depends only on which partition holds a row, so a retried
    task produces the same keys. Rows equal in the order must be identical;
    then the output is the same as a sort by the order alone.
    """
    return df.withColumn("_from_part", F.spark_partition_id()).orderBy(*order, F.col("_from_part")).drop("_from_part")


def rows_after(df: DataFrame, keys: list[str], last: tuple) -> DataFrame:
    """Rows that follow the key ``last`` in ascending order of ``keys``,
    nulls last: the next page is a top-k of these, however deep it lies."""
    after, equal = F.lit(False), F.lit(True)
    for k, v in zip(keys, last):
        c = F.col(k)
        more = F.lit(False) if v is None else (c > F.lit(v)) | c.isNull()
        after = after | (equal & F.coalesce(more, F.lit(False)))
        equal = equal & (c.isNull() if v is None else F.coalesce(c == F.lit(v), F.lit(False)))
    return df.filter(after)
