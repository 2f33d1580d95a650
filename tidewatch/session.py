"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE on; the partition count is left to AQE unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for `purpose` below the checkpoint directory of the cluster.

    Only where the session names none (local tests) a temporary folder of this machine is taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewatch-")
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
