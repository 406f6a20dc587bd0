"""Session construction and the shared scratch/checkpoint location.

On a cluster the operator reads ``spark.checkpoint.dir`` from the session (a
shared, fault-tolerant folder). Only when nothing is configured - local runs and
tests - do we create a local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # transformWithState needs the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "eventflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the session (cluster) names one; sets a
    local folder only when it is unset, as in tests and local runs.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a JVM context (e.g. Spark Connect)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="eventflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root (never reused)."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, keep_partitioning: bool = True):
    """Cut lineage into the shared checkpoint root.

    ``keep_partitioning``: a reliable ``checkpoint()``, which keeps the plan's
    output partitioning for later joins (the plan is persisted first: an eager
    checkpoint of an unpersisted plan computes it twice). Otherwise the rows
    are written once as a parquet table there and read back - one job."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    if not keep_partitioning:
        path = scratch_path(spark, "table")
        df.write.parquet(path)
        return spark.read.parquet(path)
    checkpoint_root(spark)
    df = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out
