"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens.  The plan is made on the
driver from the histogram alone (at most ``capacity`` counts, whatever the number
of documents): best-fit decreasing places whole runs of equal pieces into whole
runs of equally filled sequences.  Every piece then takes its slot by its rank
among the pieces of its length.  Ranks are dealt per (length, hash bucket) with the
counts of the buckets before as an offset, so a length that most pieces share is
numbered by many tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import PATTERN, ByteBpe, loaded, tokenizer_file
from .common import pick, written

CAPACITY = 2048

#: White space in a row from which a text is not given to the compiled encoder, whose pattern matcher fails at a million.
LONG_SPACE = 500_000
_SPACES = regex.compile(r"\s{2,}")


class Slots(NamedTuple):
    """Pieces ``first_rank ...`` of one length fill ``sequences`` sequences, ``each`` of them in a row from ``offset``."""

    length: int
    first_rank: int
    sequences: int
    each: int
    first_sequence: int
    offset: int


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[Slots]:
    """Best-fit decreasing over counts: longest pieces first, each into the fullest sequence that takes it.

    Sequences with the same room are handled as runs, so the work depends on the
    number of lengths and not on the counts.
    """
    plan: list[Slots] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, sequences)
    rooms: list[int] = []  # sorted keys of runs
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fresh = -(-left // (capacity // length))
                put(capacity, opened, fresh)
                opened += fresh
                continue
            room = rooms[at]
            first, n = runs[room].pop()
            if not runs[room]:
                del runs[room], rooms[at]
            each = room // length
            used = min(n, left // each)
            if not used:
                used, each = 1, left
            plan.append(Slots(length, rank, used, each, first, capacity - room))
            put(room - each * length, first, used)
            put(room, first + used, n - used)
            rank += used * each
            left -= used * each
    return plan


_LOADED: dict[bytes, tiktoken.Encoding] = {}


def encoder(file: bytes) -> tiktoken.Encoding:
    """A compiled encoder with the vocabulary of a byte-level BPE tokenizer file, built once per Python worker.

    It merges by id, which is the file's order of merges only if ids follow that order.
    """
    key = hashlib.sha256(file).digest()
    if key not in _LOADED:
        model = ByteBpe(file)
        if (np.diff(model.table.result) <= 0).any():
            raise ValueError("the tokenizer's ids are not in the order of its merges")
        special = set(model.special.values())
        ranks = {b: i for i, b in enumerate(model.id_bytes) if i not in special}
        _LOADED.clear()
        _LOADED[key] = tiktoken.Encoding(key.hex(), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=model.special)
    return _LOADED[key]


def has_long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACES.finditer(text))


def encode(compiled: tiktoken.Encoding, file: bytes, text: str) -> bytes:
    """The ids of a text, little-endian unsigned 32-bit, whatever the length of its white space."""
    if has_long_space(text):
        model = loaded(file)
        ids = model.encode([text])[0]
        model.forget()
        return ids
    return compiled.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: each text's ids and ``end_id``, cut to ``capacity``."""
    file = tokenizer_file(tokenizer)
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())] + [T.StructField("ids", T.BinaryType())] * with_ids
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = encoder(file)
        for b in batches:
            owner, rows = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = encode(compiled, file, text or "") + end
                total = len(ids) // 4
                edges = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                for k, (s, e) in enumerate(zip(edges, edges[1:])):
                    part = ids[4 * s:4 * e]
                    owner.append(i)
                    rows.append((k, s, e - s, zlib.crc32(part), part if with_ids else None))
            if not rows:
                continue
            k, s, n, crc, part = zip(*rows)
            columns = [b.column(0).take(pa.array(owner)), pa.array(k, pa.int32()), pa.array(s, pa.int64()),
                       pa.array(n, pa.int64()), pa.array(crc, pa.int64())] + [pa.array(part, pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                   text_col: str = "text", id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and its ``ids`` on request).

    A document is its text's ids and ``end_id``; null counts as empty text, which
    still has its end.  Only a document longer than ``capacity`` is cut, and only its
    first piece may be shorter than that.  In each sequence the pieces stand without
    gaps from offset 0.  Repeated rows are packed each; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    cut = written(pieces(pick(docs, doc_id=id_col, text=text_col), tokenizer, capacity, end_id, with_ids), "pieces")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = written(cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = cut.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["length", "bucket"]) \
        .withColumn("rank", F.col("rank") + F.col("ahead")).drop("bucket", "ahead")
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "rank")

    plan = np.array(sorted(best_fit_plan(histogram, capacity)), np.int64).reshape(-1, 6).T.copy()

    def take_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, _, each, first_sequence, offset = plan
        order = (length << 44) + first_rank
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(order, (n << 44) + rank, side="right") - 1
            step = rank - first_rank[at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(first_sequence[at] + step // each[at]),
                 pa.array(offset[at] + step % each[at] * n)],
                names=[*b.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(take_slots, schema)
