"""Exact duplicates with a heavy-hitter split.

One pass turns each text into its SHA-256 after lower-casing A-Z.  A Misra-Gries
summary per partition then names the digests that may hold a large share of all
rows; adding the summaries up leaves at most ``2 / share`` candidates, whatever
the input size.  Their counts are verified exactly, and the verified winners are
broadcast, so the rows of frequent texts are answered where they are and cross no
shuffle.  All other digests, none of which holds more than ``share`` of the rows,
go through an ordinary aggregate and join.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, pick, text_bytes, written

#: A digest held by more than this share of all rows is answered map-side.
HEAVY_SHARE = 0.001


def text_digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, row, digest)``; ``row`` numbers the rows, to tell repeated rows apart."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("row", T.LongType()), T.StructField("digest", T.BinaryType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for b in batches:
            out = [hashlib.sha256(t.lower()).digest() for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(range(row, row + len(out)), pa.int64()), pa.array(out, pa.binary())],
                names=["doc_id", "row", "digest"])
            row += len(out)

    return docs.mapInArrow(digest, schema)


def misra_gries(digests: DataFrame, counters: int) -> DataFrame:
    """Per-partition Misra-Gries summaries, added up: ``(digest, estimate)``.

    An estimate never exceeds the true count and falls short of it by at most
    ``rows / (counters + 1)``.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            held.update(b.column(0).to_pylist())
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = Counter({d: n - cut for d, n in held.items() if n > cut})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()),
                                          pa.array(list(held.values()), pa.int64())], names=["digest", "n"])

    parts = digests.select("digest").mapInArrow(summarise, "digest binary, n long")
    return parts.groupBy("digest").agg(F.sum("n").alias("estimate"))


def heavy_groups(digests: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """Verified groups above ``share`` of all rows: ``(digest, keep, group_size)``, at most ``1 / share`` rows."""
    rows = digests.count()
    counters = int(2 / share)
    slack = rows / (counters + 1)
    wanted = max(2.0, rows * share)
    # estimates add up to `rows` at most, so at most rows / (wanted - slack) <= 2 / share candidates pass
    candidates = misra_gries(digests, counters).where(F.col("estimate") >= wanted - slack).select("digest")
    return (digests.join(F.broadcast(candidates), "digest", "left_semi")
            .groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                   F.count(F.lit(1)).alias("group_size"))
            .where(F.col("group_size") >= wanted))


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     share: float = HEAVY_SHARE) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty.  Of equal texts the row with the largest id stays; a null id is smaller
    than any other.  Of rows that repeat both id and text exactly one is ``kept``.
    An empty table gives an empty result.
    """
    digests = written(text_digests(pick(docs, doc_id=id_col, text=text_col)), "digests")
    heavy = written(heavy_groups(digests, share), "heavy")
    at_home = digests.join(F.broadcast(heavy), "digest")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                        F.count(F.lit(1)).alias("group_size"))
    return at_home.unionByName(rest.join(groups, "digest")).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, text_col: str = "text", share: float = HEAVY_SHARE) -> DataFrame:
    """One row of each group of equal texts, the one with the largest id, with all its columns; of equal ids the last row."""

    def decide(rows: DataFrame, number: str) -> DataFrame:
        named = pick(rows, doc_id="doc_id", row=number, text=text_col).select(F.struct("doc_id", "row").alias("doc_id"), "text")
        return exact_duplicates(named, share=share).where("kept").select("doc_id.row")

    return keep_rows(docs, decide)
