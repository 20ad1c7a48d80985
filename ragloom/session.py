"""Spark session helpers.

Everything here is plain SparkSession configuration. On a cluster the
session already exists and carries its own settings; `get_spark` only fills
in what is unset, so a cluster's `spark.checkpoint.dir`, shuffle partition
count and memory sizing always win over these local defaults.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for local runs (tests, bench). Cluster sessions keep their own values.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "ragloom", **conf) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("RAGLOOM_MASTER", "local[8]"))
    settings = dict(LOCAL_DEFAULTS)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster this setting points at shared storage and is read as is.
    Only a local session (tests) gets a scratch folder when it is unset: on a
    cluster no machine's own folder is seen by the others.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ragloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the driver tables (`{sf_dir}/{name}.parquet`)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
