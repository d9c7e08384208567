"""Merging new results into earlier ones: forecast back-fill, idempotent dump,
retention.  Each is one join or union, never a row loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_missing(column: str) -> Column:
    """Null or NaN: a value that is still to come."""
    return F.col(column).isNull() | F.isnan(column)


def forecast_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge a new forecast table into the old one.

    * an old row with missing ``y`` (null or NaN) takes ``y`` of the new table at
      the same ``(ip, ds)``; an observed ``y`` is never changed; no match stays null;
    * the new table's rows with missing ``y`` (its pending forecasts) are added,
      unless the old table holds their ``(ip, ds, training_date)`` already: merging
      the same run again changes nothing.

    Only the old table's pending rows (a horizon per source and run) enter
    the join; its observed rows, the bulk of a growing table, pass through
    without a shuffle.  Whether a pending forecast is there already is asked of the old
    rows of the same run alone, from the first pending hour on: one small aggregate of
    ``new`` names its training dates (one per run) and that hour, so a table stored by
    ``training_date`` is pruned to those partitions.  The new table holds one row per
    ``(ip, ds)``; ``max`` makes the look-up side unique even if it did not.
    """
    observed = new.where(~is_missing("y")).groupBy("ip", "ds").agg(F.max("y").alias("_new_y"))
    pending = old.where(is_missing("y"))
    filled = pending.join(observed, ["ip", "ds"], "left") \
        .withColumn("y", F.col("_new_y")).drop("_new_y").select(*old.columns)
    added = new.where(is_missing("y")).select(*old.columns).withColumn("y", F.lit(None).cast("double"))
    if "training_date" in old.columns:
        run = ["ip", "ds", "training_date"]
        first, dates = added.agg(F.min("ds"), F.collect_set("training_date")).first()
        if first is not None and dates:
            there = old.where(F.col("training_date").isin(dates) & (F.col("ds") >= F.lit(first))).select(*run)
            added = added.join(there, run, "left_anti").select(*old.columns)
    return old.where(~is_missing("y")).unionByName(filled).unionByName(added)


def forecast_pending(fc: DataFrame) -> DataFrame:
    """Rows still waiting for an observation."""
    return fc.where(is_missing("y"))


def append_new_only(existing: DataFrame, snapshot: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of ``snapshot`` not yet in ``existing`` by ``keys``: appending them
    twice adds nothing, so a retried dump is harmless.

    The last key is a time or another order: only the part of ``existing`` between the
    snapshot's first and last value is read and joined, not the whole sink.
    """
    keys = keys or ["ip", "ds"]
    first, last = snapshot.agg(F.min(keys[-1]), F.max(keys[-1])).first()
    if first is None:
        return snapshot
    there = existing.where(F.col(keys[-1]).between(F.lit(first), F.lit(last))).select(*keys)
    return snapshot.join(there, keys, "left_anti")


def series_retain(series: DataFrame, cutoff, metrics: list[str] | None = None) -> DataFrame:
    """Retention after a dump: keep samples newer than the dumped snapshot's end.

    ``metrics`` names the metrics that the dump holds; samples of any other metric
    were not dumped and stay, whatever their age.
    """
    c = F.lit(cutoff).cast("timestamp_ntz") if not hasattr(cutoff, "_jc") else cutoff
    stays = F.col("ds") > c
    if metrics is not None:
        stays = stays | ~F.coalesce(F.col("data_type").isin(metrics), F.lit(False))
    return series.where(stays)
