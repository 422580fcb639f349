"""Writers for the build outputs and the report data sets.

All writes overwrite (the build is a full rebuild). They go through Spark's
commit protocol, so a lost executor re-runs its tasks and a failed job
leaves no half-written table behind as committed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rxcover.sinks.releases import point_tables


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


# Quotes are doubled inside quoted fields, and nothing is trimmed.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; ``""`` and null both print as nothing. Fields with
    quotes, commas or line breaks are quoted."""
    df.write.mode(mode).options(**_CSV).option("emptyValue", "").option("nullValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a CSV written by :func:`write_csv` with a known schema (no
    inference pass); empty fields come back as null. A field may hold line
    breaks, so a file is read by one task; the writer makes many files."""
    return spark.read.options(**_CSV).option("multiLine", True).schema(schema).csv(path)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder this library made."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def save_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str,
                location: str | None = None) -> dict[str, str]:
    """Replace catalog tables ``database.<name>`` with the given DataFrames;
    the database is created when absent. Returns the qualified names.

    With ``location`` all tables are written to a new folder below it first
    and then pointed there together (external tables), so a failure leaves
    every old one; without, they are managed tables of the warehouse, replaced
    one by one.
    """
    if location:
        version = f"{location.rstrip('/')}/{uuid.uuid4().hex}"
        paths = {name: f"{version}/{name}" for name in tables}
        try:
            for name, df in tables.items():
                write_parquet(df, paths[name])
            return point_tables(spark, paths, database)
        except Exception:
            remove(spark, version)
            raise
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = {}
    for name, df in tables.items():
        names[name] = f"`{database}`.`{name}`"
        df.write.mode("overwrite").format("parquet").saveAsTable(names[name])
    return names


def write_reports(reports: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One Parquet table per report under ``root``; returns the paths."""
    paths = {}
    for name, df in reports.items():
        path = f"{root.rstrip('/')}/{name}"
        write_parquet(df, path)
        paths[name] = path
    return paths
