"""Releases: all outputs of a build in one folder, switched by one rename.

    <out>/releases/<id>/...    the outputs of one build, never changed again
    <out>/CURRENT              names the release that readers take

A build writes a run folder, moves it below ``releases`` and then replaces
``CURRENT`` by a rename, which HDFS and local file systems do in one step. A
reader resolves ``CURRENT`` once and sees the outputs of one build only;
whatever fails before the switch leaves the old release in place, whole. One
release before the current one is kept for readers that are still at work.
(On an object store a rename is a copy; there the file is small, but not
replaced in one step.) One build at a time may write to ``<out>``.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

POINTER = "CURRENT"
KEPT = 2


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, out_dir: str) -> dict[str, str] | None:
    """The output paths of the current release; None where no build ended."""
    out = out_dir.rstrip("/")
    p, fs = _hadoop(spark, f"{out}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    told = json.loads(text)
    return {k: f"{out}/releases/{told['release']}/{v}" for k, v in told["outputs"].items()}


def resolved(spark: SparkSession, path: str, output: str) -> str:
    """``path`` itself, or its current release's ``output`` if a build made it."""
    return (current(spark, path) or {output: path})[output]


def publish(spark: SparkSession, run_dir: str, out_dir: str, release: str, outputs: dict[str, str]) -> dict[str, str]:
    """Make the folder ``run_dir`` the current release of ``out_dir``;
    ``outputs`` names its tables' folders. Returns their paths."""
    out = out_dir.rstrip("/")
    jvm = spark._jvm
    run, fs = _hadoop(spark, run_dir)
    home, _ = _hadoop(spark, f"{out}/releases")
    target, _ = _hadoop(spark, f"{out}/releases/{release}")
    fs.mkdirs(home)
    if not fs.rename(run, target):
        raise OSError(f"can't move {run_dir} to {out}/releases")
    try:
        told, _ = _hadoop(spark, f"{out}/{POINTER}.{release}")
        stream = fs.create(told, True)
        stream.write(json.dumps({"release": release, "outputs": outputs}).encode())
        stream.close()
        _switch(spark, told, _hadoop(spark, f"{out}/{POINTER}")[0])
    except Exception:
        fs.delete(told, False)
        fs.delete(target, True)
        raise
    return {k: f"{out}/releases/{release}/{v}" for k, v in outputs.items()}


def _switch(spark: SparkSession, new, pointer) -> None:
    """The one step: the new pointer takes the old one's place."""
    jvm = spark._jvm
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(new, pointer, how)


def prune(spark: SparkSession, out_dir: str, keep: int = KEPT) -> None:
    """Remove releases but the current one and the newest others."""
    out = out_dir.rstrip("/")
    now = current(spark, out)
    home, fs = _hadoop(spark, f"{out}/releases")
    if now is None or not fs.exists(home):
        return
    name = next(iter(now.values())).split("/releases/")[1].split("/")[0]
    found = sorted(fs.listStatus(home), key=lambda s: (s.getPath().getName() == name, s.getModificationTime()))
    for s in found[:-keep]:
        fs.delete(s.getPath(), True)


# --------------------------------------------------------------------------
# catalog tables

def point_tables(spark: SparkSession, paths: dict[str, str], database: str) -> dict[str, str]:
    """Make the catalog tables ``database.<name>`` read the Parquet folders
    ``paths``; no row is copied. If one fails, those changed before it go back
    to where they were. Returns the qualified names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    undo: list[str] = []
    names = {name: f"`{database}`.`{name}`" for name in paths}
    try:
        for name, path in paths.items():
            table = names[name]
            old = _location(spark, table) if spark.catalog.tableExists(f"{database}.{name}") else None
            if old is None:
                spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
                undo.append(f"DROP TABLE {table}")
            else:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                undo.append(f"ALTER TABLE {table} SET LOCATION '{old}'")
            spark.sql(f"REFRESH TABLE {table}")
    except Exception:
        for statement in reversed(undo):
            spark.sql(statement)
        raise
    return names


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]
