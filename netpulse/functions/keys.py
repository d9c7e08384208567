"""Key helpers: series keys and labels, pseudonymous keys, dense ordinals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_key(data_type: str | Column, ip: str | Column) -> Column:
    """Store key ``<data_type>_<ip>``."""
    dt = F.col(data_type) if isinstance(data_type, str) else data_type
    k = F.col(ip) if isinstance(ip, str) else ip
    return F.concat_ws("_", dt, k)


def series_labels(data_type: str | Column, ip: str | Column) -> Column:
    """Label map of a series, ``{srcIP: ip, dataType: data_type}``."""
    dt = F.col(data_type) if isinstance(data_type, str) else data_type
    k = F.col(ip) if isinstance(ip, str) else ip
    # The label names of a series.
    return F.create_map(F.lit("srcIP"), k, F.lit("dataType"), dt)


def pseudo_ip(key: str | Column, salt: str, round_: int | Column = 0, octets: int = 4) -> Column:
    """Deterministic pseudo-IPv4 of a key: four octets from a salted SHA-256.

    ``octets`` below 4 shrinks the code space (tests use it to force collisions).
    """
    k = F.col(key) if isinstance(key, str) else key
    r = round_ if isinstance(round_, Column) else F.lit(round_)
    h = F.sha2(F.concat_ws("|", F.lit(salt), r.cast("string"), k), 256)
    octets = [F.conv(F.substring(h, 1 + 2 * i, 2), 16, 10) for i in range(octets)]
    return F.concat_ws(".", *octets)


def dense_index(df: DataFrame, order: list[Column | str], name: str = "ordinal") -> DataFrame:
    """Number the rows 0..n-1 in ``order`` without a single-task window.

    ``order`` must be a total order (unique).  The rows are range-partitioned
    and sorted, the sorted table is checkpointed so both passes below read the
    same partitions, the per-partition row counts (one row per partition) are
    turned into offsets, and each row adds its position within its partition.
    Work is spread over all partitions; only the per-partition count table,
    whose size is the number of partitions, is broadcast.
    """
    sorted_df = df.orderBy(*order).checkpoint(eager=True)
    tagged = sorted_df.withColumn("_pid", F.spark_partition_id()) \
                      .withColumn("_mid", F.monotonically_increasing_id())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid") \
        .withColumn(name, F.coalesce(F.col("_off"), F.lit(0))
                    + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)))
    return out.drop("_pid", "_mid", "_off")
