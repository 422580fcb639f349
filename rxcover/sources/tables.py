"""Parquet tables and their load status."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.functions.labels import comma


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def try_read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when the path does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def load_status(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """One row per named source: whether it exists, its row count and the
    status line. Each existing table is counted by its own aggregate (a
    metadata-only count on Parquet); missing ones get a constant row."""
    parts = []
    for name, path in sources.items():
        df = try_read_parquet(spark, path)
        if df is None:
            parts.append(spark.range(1).select(
                F.lit(name).alias("source"), F.lit(False).alias("file_exists"),
                F.lit(None).cast("long").alias("rows"), F.lit(codes.MISSING_MESSAGE).alias("message")))
        else:
            head, tail = codes.LOADED_MESSAGE.split("{n}")
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("source"), F.lit(True).alias("file_exists"), F.col("rows"),
                F.concat(F.lit(head), comma("rows"), F.lit(tail)).alias("message")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
