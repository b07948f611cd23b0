"""Session construction (S11) and the shared scratch folder.

Settings come from the environment so that the same code runs under
``spark-submit`` on a cluster and locally.  Nothing here overrides a value a
cluster has already set; the checkpoint folder in particular is read from the
session and only created locally when the session has none (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Environment variable -> Spark setting (public names, as a cluster launcher sets them).
_ENV_CONF = {
    "SPARK_SQL_SHUFFLE_PARTITIONS": "spark.sql.shuffle.partitions",
    "SPARK_DRIVER_HOST": "spark.driver.host",
    "SPARK_DRIVER_BIND_ADDRESS": "spark.driver.bindAddress",
    "SPARK_EXECUTOR_MEMORY": "spark.executor.memory",
    "SPARK_EXECUTOR_CORES": "spark.executor.cores",
}


def get_session(app_name: str = "pawnshop", master: str | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("SPARK_MASTER_URL")
    if master:
        builder = builder.master(master)
    for env, key in _ENV_CONF.items():
        if os.environ.get(env):
            builder = builder.config(key, os.environ[env])
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # window groups here are one game's tokens or one board: keep up to 64k rows in memory
        # before falling back to the spillable buffer (rows are a few dozen bytes)
        "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
    }
    for key, value in {**defaults, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Where
    neither is set, a local master gets a temporary folder (tests); any other
    raises, since its machines would not see each other's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="pawnshop-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
