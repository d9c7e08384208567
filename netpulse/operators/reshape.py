"""Wide <-> long reshaping of metrics and the nested series shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import add_hours, day_floor, hour_floor
from ..schema import METRICS
from .windows import first_write_wins


def unpivot_metrics(logs: DataFrame, ids: list[str] | None = None, metrics: list[str] | None = None,
                    name: str = "data_type", value: str = "value") -> DataFrame:
    """All metric columns at once into ``(ids..., data_type, value)``."""
    ids = ids or ["event_id", "src_ip", "timestamp"]
    metrics = metrics or METRICS
    wide = logs.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(ids, metrics, name, value)


def to_series(logs: DataFrame, metrics: list[str] | None = None, arrival: str = "event_id") -> DataFrame:
    """Long series table ``(ip, data_type, ds, value, arrival)`` at hourly samples.

    A second write to the same (ip, data_type, hour) is rejected: the first
    arrival wins, as in a time-series store with the block policy.  A log
    record writes all its metrics at one time, so the first arrival is the
    same record for every metric: it is chosen once per (ip, hour) and the
    metrics are unpivoted after, which aggregates 1/len(metrics) of the rows.
    """
    metrics = metrics or METRICS
    first = hourly_samples(logs, metrics, arrival)
    return first.unpivot(["ip", "ds", "arrival"], metrics, "data_type", "value") \
        .select("ip", "data_type", "ds", "value", "arrival")


def series_collect(series: DataFrame) -> DataFrame:
    """Nested shape ``(ip, data_type, chunk_start, samples: array<struct<ds,value>>)``.

    One array per series and day; samples are hourly, so a day has at most 24
    and no array grows with the length of the series.  ``collect_list`` runs
    as an object-hash aggregate that falls back to a spilling sort once a task
    holds many groups.
    """
    return (series.groupBy("ip", "data_type", day_floor("ds").alias("chunk_start"))
            .agg(F.array_sort(F.collect_list(F.struct("ds", "value"))).alias("samples")))


def hourly_samples(logs: DataFrame, metrics: list[str] | None = None, arrival: str = "event_id") -> DataFrame:
    """Wide first-write-wins samples: one row per (ip, hour) with every metric."""
    metrics = metrics or METRICS
    hourly = logs.select(F.col("src_ip").alias("ip"), hour_floor("timestamp").alias("ds"),
                         F.col(arrival).alias("arrival"), *[F.col(m).cast("double").alias(m) for m in metrics])
    return first_write_wins(hourly, ["ip", "ds"], "arrival")


def series_collect_wide(samples: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """``series_collect`` of every metric from wide hourly samples.

    The day's samples are collected once per (ip, day) with all metrics - a
    ninth of the rows and groups of collecting each metric's series - and the
    array is then split into one nested series per metric.
    """
    metrics = metrics or METRICS
    days = samples.groupBy("ip", day_floor("ds").alias("chunk_start")).agg(
        F.array_sort(F.collect_list(F.struct("ds", *metrics))).alias("_day"))
    def pick(m):
        return lambda x: F.struct(x["ds"].alias("ds"), x[m].alias("value"))

    per_metric = days.select("ip", "chunk_start", *[F.transform("_day", pick(m)).alias(m) for m in metrics])
    return per_metric.unpivot(["ip", "chunk_start"], metrics, "data_type", "samples") \
        .select("ip", "data_type", "chunk_start", "samples")


def series_explode(nested: DataFrame) -> DataFrame:
    """Flatten the nested shape back to rows; empty arrays give no rows."""
    return nested.select("ip", "data_type", F.inline("samples"))


def future_grid(train: DataFrame, horizon: int = 8, key: str = "ip") -> DataFrame:
    """``horizon`` hourly rows after each key's last ``ds``: ``(ip, ds)``."""
    last = train.groupBy(key).agg(F.max("ds").alias("_last"))
    seq = F.sequence(add_hours("_last", 1), add_hours("_last", horizon), F.expr("INTERVAL 1 HOUR"))
    return last.select(key, F.explode(seq).alias("ds"))


def grid_with_history(train: DataFrame, horizon: int = 8, key: str = "ip") -> DataFrame:
    """History rows ``(ip, ds, y, is_future=false)`` plus the future grid with null ``y``."""
    fut = future_grid(train, horizon, key).select(key, "ds", F.lit(None).cast("double").alias("y"),
                                                  F.lit(True).alias("is_future"))
    hist = train.select(key, "ds", "y", F.lit(False).alias("is_future"))
    return hist.unionByName(fut)
