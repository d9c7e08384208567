"""Stupid-backoff scores from n-gram count tables that are partitioned by hash.

Documents are gathered once into blocks of word ids, written as a table.  Every block
finds its distinct n-grams with their counts inside the block, so an n-gram that occurs
everywhere crosses the shuffle once per block and not once per use.  They are dealt by
hash; the sum per hash is the count table, and it answers each block how often its
n-grams occur elsewhere.  The block then scores each word and sums the logarithms per
document.  Two forms of this exchange give the same counts:

* ``"arrays"``: a row holds the n-grams that a block has in one range of hashes, sorted,
  as differences, and the answer is an array in the same order: some 6 bytes an n-gram.
  Orders from three on wait for the answers to the shorter ones: an n-gram with a part
  that no other block holds occurs in no other block and does not travel.
* ``"rows"``: a row per n-gram, summed by ``groupBy`` and joined back: some 12 bytes
  an n-gram, and as many again for each one that several blocks share.

N-grams are told apart by 64-bit hashes of their words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, text_bytes, written

ORDER = 3
BACKOFF = 0.4
#: An n-gram of two words or more counts as seen from so many occurrences in the corpus.
MIN_COUNT = 1
#: Words per block (a longer document is a block of its own) and n-grams per hash partition or range, about.
BLOCK_WORDS = 1 << 21
PART_NGRAMS = 1 << 21
#: Words of a full block per row of arrays, at least about: so many times fewer rows than n-grams.
ROW_NGRAMS = 256
ROWS_PER_BATCH = 1 << 16
SEED = 42


def pack(a: np.ndarray) -> bytes:
    """An unsigned array by byte planes, compressed: high planes of small values cost nothing."""
    width = a.dtype.itemsize
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, width).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers as their differences."""
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def ngram_hashes(words: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie inside a document, and the positions of their first words."""
    if order > 1:
        ends = np.repeat(np.cumsum(lengths), lengths)
        at = np.flatnonzero(np.arange(len(words)) + order <= ends)
    else:
        at = np.arange(len(words))
    h = words[at] + np.uint64(order)
    for k in range(1, order):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[at + k]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27)), at


def blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(block, n_words, doc_ids, lengths, vocabulary, words)``: documents as word ids of their block."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("lengths", T.BinaryType()),
                           T.StructField("vocabulary", T.BinaryType()), T.StructField("words", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, lengths, words, held = [], [], [], 0
        vocabulary: dict = defaultdict(count().__next__)

        def done(kind):
            hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in vocabulary], np.uint64)
            flat = np.concatenate(words) if words else np.empty(0, np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(flat)], pa.int64()), pa.array([ids], pa.list_(kind)),
                 pa.array([pack(np.array(lengths, np.uint64))], pa.binary()), pa.array([pack(hashes)], pa.binary()),
                 pa.array([pack(flat)], pa.binary())], names=schema.fieldNames())

        kind = None
        for b in batches:
            kind = b.column(0).type
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                w = text.lower().split()  # bytes split at space and \x09-\x0D, and lower A-Z only
                if held and held + len(w) > block_words:
                    yield done(kind)
                    block, ids, lengths, words, held = block + 1, [], [], [], 0
                    vocabulary = defaultdict(count().__next__)
                ids.append(doc_id)
                lengths.append(len(w))
                words.append(np.fromiter(map(vocabulary.__getitem__, w), np.uint32, len(w)))
                held += len(w)
        if ids:
            yield done(kind)

    return docs.mapInArrow(run, schema)


def block_ngrams(flat: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each order the block's distinct n-grams: sorted hashes, own counts, positions, entry of each position."""
    for n in range(1, order + 1):
        hashes, at = ngram_hashes(flat, lengths, n)
        found, entry, own = np.unique(hashes, return_inverse=True, return_counts=True)
        yield found, own, at, entry


def _open(block: pa.Table | pa.RecordBatch, row: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and document lengths of a block."""
    lengths, vocabulary, words = (block.column(c)[row].as_py() for c in ("lengths", "vocabulary", "words"))
    return unpack(vocabulary, np.uint64)[unpack(words, np.uint32)], unpack(lengths, np.uint64).astype(np.int64)


def ngram_rows(placed: DataFrame, order: int) -> DataFrame:
    """``(hash, block, own)``: a row per distinct n-gram of a block with its count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, block in enumerate(b.column("block").to_pylist()):
                for found, own, _, _ in block_ngrams(*_open(b, row), order):
                    for lo in range(0, len(found), ROWS_PER_BATCH):
                        some = found[lo:lo + ROWS_PER_BATCH].view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(some), pa.array(np.full(len(some), block)), pa.array(own[lo:lo + ROWS_PER_BATCH])],
                            names=["hash", "block", "own"])

    return placed.mapInArrow(run, "hash long, block long, own long")


def counts_elsewhere(ngrams: DataFrame, parts: int) -> DataFrame:
    """``(block, hash, others)``: how often an n-gram of a block occurs in all other blocks, where it does.

    The rows are dealt by hash once; the count table and its join back use that one exchange.
    """
    dealt = ngrams.repartition(parts, "hash")
    table = dealt.groupBy("hash").agg(F.sum("own").alias("total"), F.min("block").alias("first"), F.max("block").alias("last"))
    shared = table.where("first < last").select("hash", "total")
    return dealt.join(shared.hint("shuffle_hash"), "hash").select("block", "hash", (F.col("total") - F.col("own")).alias("others"))


def hash_ranges(n_words: int, block_words: int, part_ngrams: int, row_ngrams: int, width: int) -> int:
    """Leading bits of a hash that name its range: ``part_ngrams`` n-grams of an order a range, but no rows too small.

    The rows, one per order, block and range, are at most one per ``row_ngrams`` n-grams of
    full blocks, so they grow no faster than the corpus; beyond that the ranges get longer.
    """
    wanted = max(n_words // part_ngrams, width // 2).bit_length()
    return min(wanted, max(block_words // row_ngrams, 1).bit_length() - 1)


def block_counts(flat: np.ndarray, lengths: np.ndarray, order: int, answers: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each order: sorted hashes, own counts, which of them ask the other blocks, and the corpus count at each position.

    An n-gram of three words or more asks only if other blocks hold both shorter ones in
    it: where they do not, it occurs nowhere else.  ``answers`` has for each order the
    counts elsewhere of those that ask; the first order without gets no corpus counts.
    """
    shared = np.zeros(0, bool)
    for n in range(1, order + 1):
        hashes, at = ngram_hashes(flat, lengths, n)
        found, entry, own = np.unique(hashes, return_inverse=True, return_counts=True)
        asks = np.ones(len(found), bool)
        if n > 2:
            asks[entry] = shared[at] & shared[at + 1]  # the same at every place of an n-gram
        if n > len(answers):
            yield found, own, asks, None
            return
        others = np.zeros(len(found), np.int64)
        others[asks] = answers[n - 1]
        shared = np.zeros(len(flat), bool)
        shared[at] = others[entry] > 0
        seen = np.zeros(len(flat))
        seen[at] = (own + others)[entry]
        yield found, own, asks, seen


ASKED = pa.schema([("n", pa.int32()), ("range", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("own", pa.binary())])


def _asked(block: int, n: int, found: np.ndarray, own: np.ndarray, bits: int) -> pa.RecordBatch:
    """Distinct n-grams of a block, a row per range of hashes (their top ``bits``)."""
    part = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(cuts), n, np.int32)), pa.array(part[cuts]), pa.array(np.full(len(cuts), block, np.int64)),
         pa.array([pack_sorted(found[lo:hi]) for lo, hi in zip(cuts, ends)], pa.binary()),
         pa.array([pack(own[lo:hi].astype(np.uint64)) for lo, hi in zip(cuts, ends)], pa.binary())], schema=ASKED)


def ngram_arrays(placed: DataFrame, order: int, bits: int) -> DataFrame:
    """``(n, range, block, hashes, own)``: all distinct n-grams of a block in a range of hashes, sorted, and their counts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, block in enumerate(b.column("block").to_pylist()):
                flat, lengths = _open(b, row)
                for n in range(1, order + 1):
                    found, own = np.unique(ngram_hashes(flat, lengths, n)[0], return_counts=True)
                    yield _asked(block, n, found, own, bits)

    return placed.mapInArrow(run, "n int, range long, block long, hashes binary, own binary")


def longer_arrays(placed: DataFrame, replies: DataFrame, n: int, bits: int) -> DataFrame:
    """The same of the n-grams of one order that other blocks may hold, by the ``replies`` to all shorter ones."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        *_, (found, own, asks, _) = block_counts(*_open(block), n, _by_order(answers, n - 1))
        return pa.Table.from_batches([_asked(block.column("block")[0].as_py(), n, found[asks], own[asks], bits)])

    return placed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        run, "n int, range long, block long, hashes binary, own binary")


def arrays_elsewhere(arrays: DataFrame) -> DataFrame:
    """``(block, n, range, others)``: how often each n-gram of a row of ``arrays`` occurs in all other blocks, in its order."""

    def count_range(rows: pa.Table) -> pa.Table:
        asked = [unpack_sorted(h) for h in rows.column("hashes").to_pylist()]
        own = np.concatenate([unpack(c, np.uint64) for c in rows.column("own").to_pylist()])
        _, entry = np.unique(np.concatenate(asked), return_inverse=True)
        others = np.bincount(entry, weights=own).astype(np.uint64)[entry] - own
        ends = np.cumsum([len(a) for a in asked])
        return pa.table({"block": rows.column("block"), "n": rows.column("n"), "range": rows.column("range"),
                         "others": pa.array([pack(others[hi - len(a):hi]) for a, hi in zip(asked, ends)], pa.binary())})

    return arrays.groupBy("n", "range").applyInArrow(count_range, "block long, n int, range long, others binary")


def _by_order(replies: pa.Table, order: int) -> list[np.ndarray]:
    """The answers that came back to a block, per order in the order of the hashes."""
    replies = replies.sort_by([("n", "ascending"), ("range", "ascending")])
    parts: list[list[np.ndarray]] = [[np.empty(0, np.uint64)] for _ in range(order)]
    for n, data in zip(replies.column("n").to_pylist(), replies.column("others").to_pylist()):
        parts[n - 1].append(unpack(data, np.uint64))
    return [np.concatenate(p).astype(np.int64) for p in parts]


def counts_by_position(flat: np.ndarray, lengths: np.ndarray, order: int, hashes: np.ndarray,
                       others: np.ndarray) -> list[np.ndarray]:
    """For each order, the corpus count of the n-gram that starts at each position; 0 where none does."""
    levels = []
    for found, own, at, entry in block_ngrams(flat, lengths, order):
        total = own.copy()
        if len(found):
            place = np.minimum(np.searchsorted(found, hashes), len(found) - 1)
            here = found[place] == hashes
            total[place[here]] += others[here]
        seen = np.zeros(len(flat))
        seen[at] = total[entry]
        levels.append(seen)
    return levels


def backoff_scores(levels: list[np.ndarray], lengths: np.ndarray, n_corpus: int, backoff: float,
                   min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """``ln S`` of every word of a block, and how many words of context its n-gram had."""
    log_s = np.log(np.maximum(levels[0], 1) / n_corpus) if n_corpus else np.zeros(0)
    context = np.zeros(len(log_s), np.int64)
    ends = np.repeat(np.cumsum(lengths), lengths)
    for n in range(2, len(levels) + 1):
        at = np.flatnonzero(np.arange(len(log_s)) + n <= ends)
        seen, before, last = levels[n - 1][at], levels[n - 2][at], at + n - 1
        found = seen >= min_count
        log_s[last] = np.where(found, np.log(np.maximum(seen, 1) / np.maximum(before, 1)), np.log(backoff) + log_s[last])
        context[last[found]] = n - 1
    return log_s, context


def stupid_backoff(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", order: int = ORDER,
                   backoff: float = BACKOFF, min_count: int = MIN_COUNT, block_words: int = BLOCK_WORDS,
                   part_ngrams: int = PART_NGRAMS, exchange: str = "arrays", row_ngrams: int = ROW_NGRAMS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_backed_off, log_score``.

    Words are the runs between ASCII white space, A-Z lower-cased.  Counts come from
    all documents.  ``S`` of a word is the count of its longest n-gram that occurs
    ``min_count`` times or more over the count of its context, times ``backoff`` for
    each word of context given up; a single word has its share of all words.
    ``log_score`` is the mean of ``ln S`` over the words, rounded to 6 digits, and
    null without words; ``n_backed_off`` counts the words that gave up some context
    that was there (none at a ``min_count`` of 1, as the documents are the corpus).
    Null counts as empty.  Repeated rows count as often as they occur; an empty table
    gives an empty result.  ``exchange`` is the form in which n-grams meet, see above.
    """
    if exchange not in ("arrays", "rows"):
        raise ValueError(f"unknown exchange {exchange!r}")
    source = pick(docs, doc_id=id_col, text=text_col)
    placed = written(blocks(source, block_words), "blocks")
    n_corpus = placed.agg(F.sum("n_words")).first()[0] or 0
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if exchange == "rows":
        others = counts_elsewhere(ngram_rows(placed, order), max(n_corpus * order // part_ngrams, width))
    else:
        bits = hash_ranges(n_corpus, block_words, part_ngrams, row_ngrams, width)
        others = arrays_elsewhere(ngram_arrays(placed, min(order, 2), bits))
        placed = placed.repartition("block")  # dealt once for all steps that need the blocks again
        for n in range(3, order + 1):  # each order asks by the answers to the shorter ones
            others = written(others, "answers", free=True)  # the arrays they answer are not read again
            others = others.unionByName(arrays_elsewhere(longer_arrays(placed, others, n, bits)))
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_backed_off", T.LongType()), T.StructField("log_score", T.DoubleType())])

    def score(block: pa.Table, replies: pa.Table) -> pa.Table:
        flat, lengths = _open(block)
        if exchange == "rows":
            levels = counts_by_position(flat, lengths, order, replies.column("hash").to_numpy().view(np.uint64),
                                        replies.column("others").to_numpy())
        else:
            levels = [seen for _, _, _, seen in block_counts(flat, lengths, order, _by_order(replies, order))]
        log_s, context = backoff_scores(levels, lengths, n_corpus, backoff, min_count)
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(flat)) - np.repeat(starts, lengths)
        running = np.concatenate(([0], np.cumsum(context < np.minimum(place, order - 1))))
        filled = lengths > 0
        sums = np.zeros(len(lengths))
        if filled.any():  # empty documents have no segment of their own
            sums[filled] = np.add.reduceat(log_s, starts[filled])
        mean = np.round(sums / np.maximum(lengths, 1), 6)
        return pa.table({"doc_id": block.column("doc_ids").combine_chunks().flatten(), "n_words": pa.array(lengths),
                         "n_backed_off": pa.array(running[starts + lengths] - running[starts]),
                         "log_score": pa.array(mean, mask=~filled)})

    return placed.groupBy("block").cogroup(others.groupBy("block")).applyInArrow(score, schema)
