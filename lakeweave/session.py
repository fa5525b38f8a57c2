"""Session defaults and the shared scratch area."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Broadcasts are left to the planner's own size checks (file statistics at planning
# time, real shuffle sizes under AQE), so the library never forces one on a table
# that may grow.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

TASK_BYTES = 256 * 1024 * 1024
CHECKPOINT_DIR = "spark.checkpoint.dir"


def sized_for(shuffle_bytes: int, cores: int, task_bytes: int = TASK_BYTES) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes`` on ``cores`` executor cores.

    Enough shuffle partitions for each to hold ``task_bytes``, at least two waves per core; AQE joins
    those that turn out small.
    """
    partitions = max(2 * cores, math.ceil(shuffle_bytes / task_bytes))
    return {"spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes)}


def build_session(app_name: str, master: str | None = None, settings: dict[str, str] | None = None,
                  **overrides: str) -> SparkSession:
    """Session with the library defaults, then ``settings``, then ``overrides`` with ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = DEFAULTS | (settings or {}) | {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder: on a cluster the
    executors would each see a different disk.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a shared folder before running on {master}")
        root = tempfile.mkdtemp(prefix="lakeweave-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
