"""Parquet table access and the log adapter over ``events``.

``logs`` maps the driver's ``events`` table onto the typed log record.  It is
pure column arithmetic on one scan (no shuffle), so it fuses into the scan's
code-generated stage and lets filters and column pruning reach the Parquet
reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import METRICS, TIMESTAMP_FORMAT


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def logs_from_events(events: DataFrame) -> DataFrame:
    """Typed log records from ``events``; ``event_id`` is the arrival order."""
    k = _k()
    is_error = F.col("event_type") == F.lit("error")
    allow = F.when(is_error, F.lit(0)).otherwise(F.lit(1))
    drop = F.when(is_error, F.lit(1)).otherwise(F.lit(0))
    bytesin = F.round(F.col("value") * 100).cast("bigint")
    return events.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("src_ip"),
        k.alias("unq_dst_ip"),
        allow.alias("allow"),
        drop.alias("drop"),
        (allow + drop).alias("frequency"),
        (k + allow).alias("pkts_sent"),
        (k + drop).alias("pkts_received"),
        bytesin.alias("bytesin"),
        (bytesin * (k + 1)).alias("bytesout"),
        (k % 5).alias("unq_dst_port"),
        F.col("ts").alias("timestamp"),
    )


def read_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return logs_from_events(events)


def payload_from_logs(logs: DataFrame, malformed_every: int | None = None) -> DataFrame:
    """Wire records ``(key, value)``: the log as a JSON object of strings.

    ``malformed_every`` replaces the payload of every n-th arrival by text that
    is not JSON, to exercise the decoder's handling of bad records (all rows are
    kept).
    """
    fields = [
        F.col("src_ip"),
        F.date_format("timestamp", TIMESTAMP_FORMAT).alias("timestamp"),
        *[F.col(m).cast("string").alias(m) for m in METRICS],
    ]
    value = F.to_json(F.struct(*fields))
    if malformed_every:
        value = F.when(F.col("event_id") % malformed_every == 0, F.lit("not json")).otherwise(value)
    return logs.select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


def customer_registry(spark: SparkSession, sf_dir: str, exclude_segment: str = "AUTOMOBILE") -> DataFrame:
    """Registered sources: customer keys outside one market segment, as ``src_ip``."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return (cust.where(F.col("c_mktsegment") != exclude_segment)
            .select(F.col("c_custkey").cast("string").alias("src_ip")))


def customer_allowlist(spark: SparkSession, sf_dir: str, segment: str = "BUILDING") -> DataFrame:
    """Allow-list: customer keys of one market segment, as ``src_ip``."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return (cust.where(F.col("c_mktsegment") == segment)
            .select(F.col("c_custkey").cast("string").alias("src_ip")))
