"""The history table in versions: appends, compaction of small files, pinned readers.

The table holds ``(ip, ds, y)`` per metric and day.  Each append writes files of its own
and commits a version that names them beside all earlier ones.  Compaction packs the
files of a (metric, day) that are small by best fit into bins of the target size,
rewrites each bin as one sorted file and commits a version with the new files in place
of the old; a reader of the old version keeps its files until ``expire``.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import commit, drop_versions, entries, folder, versions

#: Files below half of this are packed together.
TARGET_BYTES = 128 << 20

ROWS = T.StructType([T.StructField("ip", T.StringType()), T.StructField("ds", T.TimestampNTZType()), T.StructField("y", T.DoubleType())])


def _written(spark: SparkSession, into: str) -> list[dict]:
    """The data files below a folder just written, with metric, day and size."""
    fs, path = folder(spark, into)
    out = []
    files = fs.listFiles(path, True)
    while files.hasNext():
        f = files.next()
        name = str(f.getPath().toString())
        parts = dict(x.split("=", 1) for x in name.split("/") if "=" in x)
        if name.endswith(".parquet"):
            out.append({"path": name, "data_type": parts["data_type"], "day": parts["day"], "bytes": f.getLen()})
    return out


def files(spark: SparkSession, root: str, version: int | None = None) -> list[dict]:
    """The files of a version (default: the newest): ``path, data_type, day, bytes``."""
    known = versions(spark, root)
    if not known:
        return []
    return entries(spark, root, known[-1] if version is None else version)


def append(df: DataFrame, root: str, data_type: str) -> int:
    """Append the rows ``(ip, ds, y)`` of one metric; returns the new version."""
    spark = df.sparkSession
    into = f"{root}/data/{uuid.uuid4().hex}"
    rows = df.select("ip", "ds", "y", F.lit(data_type).alias("data_type"), F.to_date("ds").alias("day"))
    (rows.repartitionByRange("day", "ip", "ds").sortWithinPartitions("data_type", "day", "ip", "ds")
     .write.partitionBy("data_type", "day").parquet(into))
    version = (versions(spark, root) or [-1])[-1] + 1
    commit(spark, root, version, files(spark, root) + _written(spark, into))
    return version


def read(spark: SparkSession, root: str, data_type: str | None = None, start: str | None = None, end: str | None = None,
         version: int | None = None) -> DataFrame:
    """``(ip, ds, y, data_type)`` of a version, by metric and days ``start`` to ``end`` (both included).

    Only files of those metrics and days are opened.
    """
    chosen = [f for f in files(spark, root, version) if (data_type is None or f["data_type"] == data_type)
              and (start is None or f["day"] >= start) and (end is None or f["day"] <= end)]
    out = None
    for metric in sorted({f["data_type"] for f in chosen}):
        part = spark.read.schema(ROWS).parquet(*[f["path"] for f in chosen if f["data_type"] == metric]).withColumn("data_type", F.lit(metric))
        out = part if out is None else out.unionByName(part)
    empty = T.StructType([*ROWS.fields, T.StructField("data_type", T.StringType())])
    return out if out is not None else spark.createDataFrame([], empty)


def pack_files(sizes: list[int], target: int) -> list[list[int]]:
    """Best fit, largest first: the places of the sizes in bins of at most ``target`` (a larger size is a bin of its own)."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free bytes, bin), sorted
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = max(target, sizes[i]), len(bins)
            bins.append([])
        bins[b].append(i)
        insort(room, (free - sizes[i], b))
    return bins


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES) -> int | None:
    """Pack the small files of every (metric, day); returns the new version, or ``None`` if nothing was to be packed.

    A bin becomes one file sorted by source and time, written by one task of at most
    ``target_bytes`` of input; bins of all days are written side by side.
    """
    known = versions(spark, root)
    now = files(spark, root)
    by_day: dict[tuple[str, str], list[dict]] = {}
    for f in now:
        if f["bytes"] < target_bytes // 2:
            by_day.setdefault((f["data_type"], f["day"]), []).append(f)
    bins = [(key, [held[i] for i in b]) for key, held in sorted(by_day.items())
            for b in pack_files([f["bytes"] for f in held], target_bytes) if len(b) > 1]
    if not bins:
        return None
    into = f"{root}/data/{uuid.uuid4().hex}"
    # a row per small file: where its rows go
    places = spark.createDataFrame([(f["path"].split("/data/")[-1], n, *key) for n, (key, held) in enumerate(bins) for f in held],
                                   "file string, bin int, data_type string, day string")
    old = spark.read.schema(ROWS).parquet(*[f["path"] for _, held in bins for f in held]) \
        .select("*", F.element_at(F.split("_metadata.file_path", "/data/"), -1).alias("file"))
    (old.join(places, "file").repartitionByRange(len(bins), "bin").sortWithinPartitions("data_type", "day", "ip", "ds")
     .select("ip", "ds", "y", "data_type", "day").write.partitionBy("data_type", "day").parquet(into))
    gone = {f["path"] for _, held in bins for f in held}
    commit(spark, root, known[-1] + 1, [f for f in now if f["path"] not in gone] + _written(spark, into))
    return known[-1] + 1


def expire(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all versions but the newest ``keep`` and the files none of them names; how many files went.

    Run it when nothing is being written and no reader holds an older version.
    """
    named = {f["path"] for v in drop_versions(spark, root, keep) for f in entries(spark, root, v)}
    loose = [f["path"] for f in _written(spark, f"{root}/data") if f["path"] not in named]
    for path in loose:
        fs, p = folder(spark, path)
        fs.delete(p, False)
    return len(loose)
