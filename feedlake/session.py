"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.speculation": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "feedlake") -> SparkSession:
    """Return the active session or build a local one with sane defaults.

    On a cluster the session already exists (spark-submit); this only fills in
    settings for local runs and tests.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app).master(master or os.environ.get("SPARK_MASTER", "local[8]"))
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session without one gets its own
    folder (tests, laptops); a cluster session without one is a configuration
    error, because a machine-local folder is invisible to other executors.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(found)
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # not local-cluster
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="feedlake-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder under the shared root for one run's output."""
    return f"{shared_root(spark)}/feedlake-{tag}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
