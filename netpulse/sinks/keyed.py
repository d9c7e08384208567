"""Keyed upsert sink: a table of the current value per key, updated batch by batch.

The table lies in hash buckets of the key.  A batch rewrites the buckets it touches,
each old bucket merged with the batch's rows, under a path of its own, and then writes a
manifest: one small file that names, for every bucket, the folder that holds it, and the
last batch it covers.  The manifest is the commit.  A crash before it leaves folders
that nothing names; a replayed batch finds its id covered and changes nothing; a reader
keeps the manifest it started from, and its files stay until ``expire``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import commit, drop_versions, entries, folder, versions

#: Buckets of a new table: about one for every 128 MB the table will hold.
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    """A version of the table: what it holds where, and up to which batch."""

    version: int
    last_batch: int
    key: str
    buckets: int
    schema: str
    folders: dict[int, str]


def _write_manifest(spark: SparkSession, root: str, m: Manifest) -> None:
    commit(spark, root, m.version, [{**vars(m), "folders": {str(b): f for b, f in m.folders.items()}}])


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version, the newest by default; ``None`` for a table without one."""
    if version is None:
        known = versions(spark, root)
        if not known:
            return None
        version = known[-1]
    m = entries(spark, root, version)[0]
    return Manifest(**{**m, "folders": {int(b): f for b, f in m["folders"].items()}})


def _rows(spark: SparkSession, m: Manifest, buckets: list[int]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(m.schema))
    folders = [m.folders[b] for b in buckets if b in m.folders]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version (default: the newest): one row per key."""
    m = read_manifest(spark, root, version)
    if m is None:
        raise FileNotFoundError(f"{root}: no committed version")
    return _rows(spark, m, sorted(m.folders))


def upsert_batch(df: DataFrame, root: str, batch_id: int, key: str, buckets: int = BUCKETS, order: str | None = None) -> bool:
    """Put a batch's rows into the table; whether it did (a batch that is covered already changes nothing).

    Of several rows of a key in a batch the one with the largest ``order`` wins; without
    ``order`` the batch must hold each key once.  Null is a key.  Only the touched
    buckets are read and written; the number of buckets is fixed by the first batch.
    """
    spark = df.sparkSession
    now = read_manifest(spark, root)
    if now is not None and batch_id <= now.last_batch:
        return False
    if now is None:
        now = Manifest(-1, -1, key, buckets, df.schema.json(), {})
    elif now.key != key or [(f.name, f.dataType) for f in T.StructType.fromJson(json.loads(now.schema))] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{root}: the table holds other columns or another key")
    version = now.version + 1
    into = f"{root}/data/version={version:012d}-{uuid.uuid4().hex}"

    def bucketed(rows: DataFrame, age: int) -> DataFrame:
        return rows.select("*", F.pmod(F.xxhash64(F.col(key)), F.lit(now.buckets)).cast("int").alias("_bucket"), F.lit(age).alias("_age"))

    # the batch is read twice: for the buckets it touches, and to be written
    touched = sorted(r[0] for r in bucketed(df, 1).select("_bucket").distinct().collect())  # at most `buckets` numbers
    if touched:
        both = bucketed(_rows(spark, now, touched), 0).unionByName(bucketed(df, 1))
        rank = F.struct("_age", order) if order else F.col("_age")
        row = F.struct(*[F.col(c) for c in df.columns])
        newest = both.groupBy("_bucket", F.col(key).alias("_key")).agg(F.max_by(row, rank).alias("_row"))
        newest.select("_bucket", "_row.*").repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(into)
    folders = {**now.folders, **{b: f"{into}/_bucket={b}" for b in touched}}
    _write_manifest(spark, root, Manifest(version, batch_id, key, now.buckets, now.schema, folders))
    return True


def start_upsert(stream: DataFrame, root: str, checkpoint: str, key: str, buckets: int = BUCKETS, order: str | None = None,
                 trigger: dict | None = None, state_partitions: int | None = None):
    """Run an update-mode stream into the table; each trigger upserts the changed keys."""
    from ..streaming.jobs import _start
    w = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: upsert_batch(df, root, batch_id, key, buckets, order) and None)
         .trigger(**(trigger or {"availableNow": True})))
    return _start(w, stream.sparkSession, state_partitions)


def expire(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete the manifests but the newest ``keep`` and the bucket folders that none of those names; how many folders went.

    Folders of a crashed batch are among them.  Run it when no batch is being written
    and no reader holds an older version.
    """
    named = {f for v in drop_versions(spark, root, keep) for f in read_manifest(spark, root, v).folders.values()}
    gone = 0
    fs, data = folder(spark, f"{root}/data")
    for attempt in fs.listStatus(data) if fs.exists(data) else []:
        name = attempt.getPath().getName()
        held = [s.getPath() for s in fs.listStatus(attempt.getPath()) if s.isDirectory()]
        loose = [p for p in held if f"{root}/data/{name}/{p.getName()}" not in named]
        for p in loose:
            fs.delete(p, True)
        gone += len(loose)
        if len(loose) == len(held):
            fs.delete(attempt.getPath(), True)
    return gone
