"""Session settings and the shared scratch location.

Every job in the library runs on a session that has UTC as its time zone (the
log timestamps are wall-clock text), adaptive execution on (runtime partition
coalescing, skew-join splitting and broadcast conversion behind a measured
size) and Arrow on (only used by the two pandas steps, the batched model solve
and the public per-key hook).

Intermediate tables (stream checkpoints, staged payloads, versioned outputs)
go under ``spark.checkpoint.dir``: on a cluster that is the shared folder the
operator configured.  Only a local session without that setting gets a private
temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # batches to Python are bounded in bytes too: 10,000 long rows would not fit
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # keyed stream state (one entry per source) lives off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for a large cluster (1000 executors, ~100 TB input): many shuffle
# partitions that adaptive execution coalesces to ~128 MB each, skewed
# partitions split above 256 MB, scan splits of 256 MB, Kryo serialisation
# and off-heap-friendly RocksDB state.  Pass as ``extra`` to ``build_session``
# (or set in the cluster's defaults); static settings only take effect when
# the session is created.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "netpulse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # checkpoint files of DataFrames that are gone are deleted, so repeated
    # jobs do not fill the shared checkpoint folder
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``; a local session without it gets a
    temporary folder, a cluster session without it is an error (a
    machine-local folder is not visible to the other executors).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="netpulse-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run."""
    return "/".join([checkpoint_root(spark), "netpulse", *parts, uuid.uuid4().hex])
