"""Session settings and the shared folder used for stream state and written tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# AQE splits skewed join partitions and sizes reduce tasks at run time, so
# `shuffle.partitions` stays the cluster's own choice.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # no Python call site per column expression: building wide plans gets several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def sized_for(shuffle_gb: float, task_mb: int = 200) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_gb``: enough partitions for ``task_mb`` each.

    AQE starts from that number and merges small partitions, so a high guess costs little.
    """
    partitions = max(200, math.ceil(shuffle_gb * 1024 / task_mb))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{task_mb}m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def build_session(app: str = "tidemerge", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may fall back to /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemerge-")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/tidemerge/{label}-{uuid.uuid4().hex}"
