"""The long series table on Parquet: layout and range scans.

Layout: partitioned by ``data_type`` and ``day`` (the date of ``ds``).  Rows are
rebalanced by the two columns before the write: small directories share a task, and
adaptive execution splits a day with many sources over several tasks by its size.  A
range scan of one metric names both partition columns, so Spark lists and
reads only the matching directories, and pushes the ``ds`` bounds into the
Parquet reader for row-group skipping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SERIES_SCHEMA


def write_series(series: DataFrame, path: str, mode: str = "errorifexists") -> str:
    cols = [f.name for f in SERIES_SCHEMA.fields]
    (series.select(*cols).withColumn("day", F.to_date("ds"))
     .hint("rebalance", "data_type", "day")
     .write.mode(mode).partitionBy("data_type", "day").parquet(path))
    return path


def range_scan(spark: SparkSession, path: str, data_type: str, start: str | None = None,
               end: str | None = None, ordered: bool = False) -> DataFrame:
    """Samples of one metric with ``start <= ds <= end``.  ``ordered`` sorts
    them by (ip, ds), earliest to latest per series - a range-partitioned
    sort, so only ask for it where a consumer needs the order."""
    df = spark.read.parquet(path).where(F.col("data_type") == data_type)
    if start is not None:
        s = F.lit(start).cast("timestamp_ntz")
        df = df.where((F.col("ds") >= s) & (F.col("day") >= F.to_date(s)))
    if end is not None:
        e = F.lit(end).cast("timestamp_ntz")
        df = df.where((F.col("ds") <= e) & (F.col("day") <= F.to_date(e)))
    df = df.select(*[f.name for f in SERIES_SCHEMA.fields])
    return df.orderBy("ip", "ds") if ordered else df
