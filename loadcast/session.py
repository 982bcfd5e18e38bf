"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline is written for. Time columns are timestamp_ntz and every
# time expression is zone-free, but UTC keeps any display of instants unambiguous.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Large input splits: the raw-session scan is the only step whose task count grows
    # with the data, and its partial aggregate keeps shuffle output small per task.
    "spark.sql.files.maxPartitionBytes": "512m",
}


def build_session(master: str | None = None, app: str = "loadcast",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Session for scripts and tests. On a cluster, ``master`` stays None."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system): without it this fails. Only on a
    local master a folder is created here and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = os.path.dirname(current.rstrip("/"))
    if not root and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="loadcast-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
