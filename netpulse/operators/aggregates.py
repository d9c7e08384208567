"""Grouped aggregates.  All are decomposable, so Spark combines map-side
before the shuffle and a hot key costs one partial row per input partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import hour_floor


def avg_by_key(df: DataFrame, key: str = "src_ip", metric: str | Column = "unq_dst_ip",
               out: str = "avg_unq_dst_ip", dedup_on: list[str] | None = None,
               arrival: str = "event_id") -> DataFrame:
    """Mean of ``metric`` per key.  ``dedup_on`` first keeps one record per
    those columns (the earliest ``arrival``), so a repeated record is counted
    once, as the series store counts it."""
    if dedup_on:
        from .windows import first_write_wins
        df = first_write_wins(df, dedup_on, arrival)
    m = F.col(metric) if isinstance(metric, str) else metric
    return df.groupBy(key).agg(F.avg(m).alias(out))


def sum_by_key_hour(logs: DataFrame, metric: str = "unq_dst_ip", key: str = "src_ip",
                    ts: str = "timestamp") -> DataFrame:
    """Training frame ``(ip, ds, y)``: metric summed per key and hour."""
    return (logs.groupBy(F.col(key).alias("ip"), hour_floor(ts).alias("ds"))
            .agg(F.sum(metric).cast("double").alias("y")))


def distinct_keys(df: DataFrame, key: str = "src_ip") -> DataFrame:
    return df.select(key).distinct()


def count_by_key(df: DataFrame, key: str = "ip", out: str = "n_rows") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: str | None = None) -> DataFrame:
    """RMSE and MAE, per ``by`` and overall (``by`` null on the total row).

    Rows without a prediction or label are left out.
    """
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    scored = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sqrt(F.sum(err * err) / F.count(F.lit(1))).alias("rmse"),
            (F.sum(F.abs(err)) / F.count(F.lit(1))).alias("mae")]
    if by is None:
        return scored.agg(*aggs)
    return scored.rollup(by).agg(*aggs)
