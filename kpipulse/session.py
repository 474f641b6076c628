"""SparkSession helpers.

Library code never builds its own session; it takes one. ``get_session`` is
for tests, the bench and scripts: it pins UTC, AQE and a local checkpoint
folder only when the cluster has not named one.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "kpipulse") -> SparkSession:
    builder = (
        SparkSession.builder.master(master or os.environ.get("KPIPULSE_MASTER", "local[8]"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KPIPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is (and handed to the SparkContext if it has not picked it up). A scratch
    folder of this machine is created only for a local master (tests, local
    runs), and removed when the process ends; on a cluster, where executors
    could not see each other's files in it, an unset folder is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = tempfile.mkdtemp(prefix="kpipulse-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the application's folder in the checkpoint
    folder (stream outputs, stored intermediate tables). Nothing is created
    here: Spark creates the folder on write, on whatever file system the path
    names. ``remove_scratch`` ends its lifetime."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kpipulse-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written under ``scratch_dir``.
    For the end of an application: its DataFrames read from there."""
    from .sources import files as FS

    FS.delete(spark, _own_scratch(spark))
