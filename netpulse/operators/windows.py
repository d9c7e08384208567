"""Ordered, per-key operators: lag, last-n, first-write-wins, top rows.

A window partitioned by the key alone puts a hot key (a third of all rows, say)
in one task.  ``lag_by_key`` therefore windows over (key, time bucket), with
finer buckets where a bucket is hot, and patches the first row of each bucket
with the last value of the key's previous bucket, taken from a per-bucket
aggregate.  ``tail_n_per_key`` is a ranking
filter, which Spark plans with a partial group limit before the shuffle, so at
most n rows per key and input partition travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_by_key(df: DataFrame, key: str, order: list[str], value: str, out: str,
               bucket_seconds: int = 86400, fine_seconds: int = 60, max_bucket_rows: int | None = 2_000_000,
               time_col: str | None = None) -> DataFrame:
    """Previous ``value`` per key in ``order`` (first row of a key: null).

    ``order`` must be a total order within a key, its first column a time.
    A null key or time is a key or bucket of its own, held under a stand-in value so
    that all joins are plain equalities.  Rows are windowed per (key, time bucket).  Buckets are ``bucket_seconds``
    long; a (key, bucket) with more than ``max_bucket_rows`` rows is cut into
    ``fine_seconds`` buckets instead, so a hot key is spread over many tasks.
    The list of such hot buckets has at most rows / ``max_bucket_rows``
    entries, which bounds its broadcast.  Bucket ids are bucket start times,
    so coarse and fine buckets of one key stay in time order.
    """
    t = F.unix_micros(F.col(time_col or order[0]).cast("timestamp"))
    coarse_us, fine_us = bucket_seconds * 1_000_000, fine_seconds * 1_000_000
    coarse = (F.floor(t / F.lit(coarse_us)) * F.lit(coarse_us)).cast("bigint")
    fine = (F.floor(t / F.lit(fine_us)) * F.lit(fine_us)).cast("bigint")
    never = F.lit(-(1 << 62))
    b = df.withColumn("_k", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))) \
        .withColumn("_cb", F.coalesce(coarse, never))
    if max_bucket_rows:
        hot = b.groupBy("_k", "_cb").agg(F.count(F.lit(1)).alias("_n")) \
            .where(F.col("_n") > max_bucket_rows).select("_k", "_cb", F.lit(True).alias("_hot"))
        b = b.join(F.broadcast(hot), ["_k", "_cb"], "left") \
            .withColumn("_b", F.when(F.col("_hot"), F.coalesce(fine, never)).otherwise(F.col("_cb"))).drop("_hot")
    else:
        b = b.withColumn("_b", F.col("_cb"))
    b = b.drop("_cb")
    w = Window.partitionBy("_k", "_b").orderBy(*order)
    inner = b.withColumn(out, F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    # the last value of each bucket comes from an aggregate, so only a row per bucket and input partition travels for it
    last = b.groupBy("_k", "_b").agg(F.max_by(F.col(value), F.struct(*order)).alias("_last"))
    prev = last.select("_k", "_b", F.lag("_last").over(Window.partitionBy("_k").orderBy("_b")).alias("_prev"))
    # plain equality on the window's own, never-null columns: the rows are already dealt by them
    res = inner.join(prev, ["_k", "_b"], "left") \
        .withColumn(out, F.when(F.col("_first"), F.col("_prev")).otherwise(F.col(out)))
    return res.select(*df.columns, out)


def tail_n_per_key(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """Last ``n`` rows per key in ``order`` (a total order)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def first_write_wins(df: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """One row per ``keys``: the earliest arrival (later writes are rejected).

    An aggregate, so it combines map-side and a duplicate-heavy key never
    gathers in one task.  ``arrival`` must be unique within a key group (an
    arrival sequence number).  Each column is taken with its own
    ``min_by(column, arrival)``: with fixed-width columns every buffer is
    fixed-width and Spark plans a hash aggregate, where one ``min_by`` over a
    struct of all columns would force a sort of every input partition.
    Column order is kept.
    """
    rest = [c for c in df.columns if c not in keys and c != arrival]
    aggs = [F.min(arrival).alias(arrival)] + [F.min_by(F.col(c), F.col(arrival)).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def preview_top(df: DataFrame, order: list[str], n: int = 50) -> DataFrame:
    """First ``n`` rows in ``order``: a distributed top-k (per-partition top-n, then merge)."""
    return df.orderBy(*order).limit(n)
