"""Structured Streaming jobs: running average per key, its changelog,
per-record routing to a partition, and de-duplication of repeated records.

Results leave a stream through ``foreachBatch`` into a Parquet changelog keyed
by ``batch_id`` (a replayed batch rewrites only its own partition), or through
the append-only file sink.  State lives in the query's checkpoint under the
shared checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import decode_payload, tolerant_number
from ..sinks.files import write_batch_idempotent


def running_average(records: DataFrame, metric: str = "unq_dst_ip", key: str = "src_ip",
                    out: str = "avg_unq_dst_ip") -> DataFrame:
    """All-time mean of ``metric`` per key from JSON records.

    Only the two fields used are parsed.  Text that is not a number counts as
    missing; a record that is not JSON lands in the null-key group.
    """
    decoded = decode_payload(records, fields=[key, metric], keep=[])
    return decoded.groupBy(key).agg(F.avg(tolerant_number(metric)).alias(out))


def running_average_typed(logs: DataFrame, metric: str = "unq_dst_ip", key: str = "src_ip",
                          out: str = "avg_unq_dst_ip") -> DataFrame:
    return logs.groupBy(key).agg(F.avg(metric).alias(out))


_STARTING = threading.Lock()


def _start(writer, spark: SparkSession, state_partitions: int | None):
    """Start a query with ``state_partitions`` shuffle partitions.

    A stateful query keeps the partition count of its first start in its
    checkpoint for good, so it is chosen here explicitly (default: the
    cluster's cores) instead of inheriting whatever the session holds.  Streams
    built on a session of their own (``stream_session``) leave the caller's alone.
    """
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    with _STARTING:  # two starts never see each other's value
        old = spark.conf.get(key)
        spark.conf.set(key, str(n))
        try:
            return writer.start()
        finally:
            spark.conf.set(key, old)


def start_changelog(agg: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                    query_name: str | None = None, state_partitions: int | None = None):
    """Run an aggregate in update mode; each trigger appends the changed keys
    to ``table`` under its ``batch_id``."""
    w = (agg.writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: write_batch_idempotent(df, table, batch_id)))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return _start(w, agg.sparkSession, state_partitions)


def latest_by_key(changelog: DataFrame, key: str = "src_ip", value: str = "avg_unq_dst_ip") -> DataFrame:
    """Current value per key: the one written by the latest batch."""
    return changelog.groupBy(key).agg(F.max_by(F.col(value), F.col("batch_id")).alias(value))


def changelog_kv(latest: DataFrame, key: str = "src_ip", value: str = "avg_unq_dst_ip") -> DataFrame:
    """Key/value text records of a changelog (the sink's projection)."""
    return latest.select(F.col(key).alias("key"), F.col(value).cast("string").alias("value"))


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for a stream's frames, with settings of its own."""
    from ..session import checkpoint_root, configure
    checkpoint_root(spark)
    return configure(spark.newSession())


def drop_repeats(logs: DataFrame, keys: list[str] | None = None, ts: str = "timestamp",
                 delay: str | None = None) -> DataFrame:
    """Drop repeats of ``keys`` from a stream.

    By default every key ever seen is remembered, so a late row is dropped only if
    it is a repeat; the state grows with the number of distinct keys.  With ``delay``
    the state is bounded by a watermark instead, at a price the caller must want:
    rows later than ``delay`` are dropped, whether they are repeats or not.  Event
    time must be ``timestamp``, so the wall-clock column is cast.
    """
    keys = keys or ["src_ip", "event_time"]
    timed = logs.withColumn("event_time", F.col(ts).cast("timestamp"))
    if delay is None:
        return timed.dropDuplicates(keys).drop("event_time")
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(keys).drop("event_time")


def run_to_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 state_partitions: int | None = None):
    """Append-mode stream into a Parquet folder (exactly-once file sink)."""
    w = (stream.writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    return _start(w, stream.sparkSession, state_partitions)


def await_done(query, timeout_s: int | None = None) -> None:
    """Wait until a query ends, however long its input takes; raise what it raised.

    With ``timeout_s`` the wait is cut short with ``TimeoutError``; the query goes on.
    """
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        raise TimeoutError("the stream has not ended yet")
    exc = query.exception()
    if exc is not None:
        raise exc


def compact_changelog(spark: SparkSession, table: str, path: str, key: str = "src_ip",
                      value: str = "avg_unq_dst_ip") -> str:
    """Write the latest value of each key as a new version, keyed by the last batch it covers.

    A reader then needs this version and the later batches only; the batches it
    covers may be deleted once no reader uses them.
    """
    log = spark.read.parquet(table)
    last = log.agg(F.max("batch_id")).first()[0]
    latest_by_key(log, key, value).withColumn("batch_id", F.lit(last).cast("bigint")).write.mode("errorifexists").parquet(path)
    return path


def route_records(records: DataFrame, pmap: DataFrame, key: str = "src_ip") -> DataFrame:
    """Stream routing: decode each record's key and attach its partition from
    a static key map (a stream-static join; the map is broadcast behind the
    row bound).  Records with an unknown or unreadable key are dropped, as
    the batch routing drops them."""
    from ..operators.joins import bounded_broadcast
    from ..session import checkpoint_root
    checkpoint_root(records.sparkSession)
    # the static side is written once: its lineage (ordinal numbering) holds
    # expressions a streaming plan refuses, and every trigger would recompute it
    static = pmap.select(key, "partition").checkpoint(eager=True)
    decoded = decode_payload(records, fields=[key], keep=["key", "value"])
    return decoded.join(bounded_broadcast(static), key, "inner") \
        .select(F.col("key").alias("record_key"), key, "partition", "value")
