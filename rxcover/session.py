"""Session helpers: a local session for tests and the bench, and the shared
scratch folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "rxcover", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster, build the session with the cluster's own settings instead;
    nothing in the library depends on these values.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         # Python call-site capture for every Column (used only to decorate
         # error messages) costs about 2 ms per expression on the driver.
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.driver.memory", os.environ.get("RXCOVER_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When it is unset and the session runs in local mode (one machine, so a
    machine folder is shared by every task), a fresh folder is created and
    set. On a cluster an unset value is an error: intermediate tables must
    go to a folder every executor can read.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context
        sc = None
    d = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = tempfile.mkdtemp(prefix="rxcover-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared scratch folder (``<checkpoint dir>/rxcover``)."""
    tail = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return "/".join([checkpoint_dir(spark), "rxcover", *tail])
