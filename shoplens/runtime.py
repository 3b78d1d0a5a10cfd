"""Spark session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names (a path every executor
can reach). Only when the session has none -- local tests -- a private folder is created and set.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that hold at any scale: AQE re-plans joins/partition counts from runtime sizes,
# splits skewed shuffle partitions, and coalesces tiny ones. The broadcast threshold stays at
# Spark's size-checked default; explicit broadcast hints are used only for fixed-size sides.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state lives in RocksDB (off-heap, spills to local disk, checkpointed to the
    # shared folder) so per-key running counts do not have to fit in executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

STATE_STORE_ROCKSDB = DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"]


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Cluster settings sized from the input: about ``partition_bytes`` per scan split and per
    shuffle partition before AQE coalescing, at least three tasks per core, skew splitting for
    partitions five times the median, and broadcasts only below 64 MB measured at runtime."""
    parts = max(3 * total_cores, input_bytes // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(16 << 20),
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE_ROCKSDB,
    }


def build_session(master: str | None = None, app_name: str = "shoplens",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jdir.get() if jdir.isDefined() else None


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a private one is created only when none is set."""
    root = _configured_dir(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # a running session's spark.checkpoint.dir cannot be changed: the context keeps the folder
        root = tempfile.mkdtemp(prefix="shoplens-ckpt-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path below the shared checkpoint folder (for stream checkpoints and tables)."""
    root = checkpoint_root(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    if "://" in root and not root.startswith("file:"):
        return "/".join([root.rstrip("/")] + leaf)
    base = root[len("file:"):] if root.startswith("file:") else root
    return os.path.join(base, *leaf)


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Apply SQL settings for the duration of a block (e.g. while a streaming query starts and
    fixes its state partitioning), then restore the previous values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and return a DataFrame reading it back:
    for a small intermediate (e.g. one row per session) that feeds several branches, so the
    large input behind it is scanned once, and the lineage is cut (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
