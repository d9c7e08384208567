"""SimHash near-duplicates through pivot distance tables.

Every text becomes a 64-bit fingerprint of its word shingles.  Equal fingerprints
form one class, and only classes are compared.  Two classes within ``max_bits``
differing bits agree on at least ``blocks - max_bits`` of ``blocks`` bit blocks, so
each class is dealt to every choice of that many blocks and meets its partners
there; the number of blocks follows the number of classes and changes the work,
never the result.  Inside a meeting place the distances of every fingerprint to
many fixed reference fingerprints (the pivot table) are laid out once.  By the
triangle inequality two fingerprints within ``max_bits`` differ by at most
``max_bits`` in every coordinate: pairs with a larger maximum coordinate
difference are discarded, and the survivors are verified bit by bit.

A small group compares its members in place.  A large one is walked from member to
member against those not yet reached, so a dense cluster of many thousand copies
costs a few passes and gives a spanning forest instead of all its pairs.  A meeting
place of more than ``HOT_PLACE`` members is dealt again by choices of finer blocks:
two members within ``max_bits`` agree on one of those choices too, so its pairs are
split over many tasks and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, pick, text_bytes, written
from .components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
N_PIVOTS = 32
#: Groups up to this size compare neighbours in place, larger ones are walked.
SMALL_GROUP = 48
#: Larger meeting places are dealt again, by so many blocks more.
HOT_PLACE = 1 << 14
FINER_BLOCKS = 3
SEED = 42


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints, derived from their number by a fixed hash."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED) for i in range(n)], np.uint64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the lower-cased word shingles; zero without words."""
    w = text.lower().split()  # bytes split at space and \\x09-\\x0D, and lower A-Z only
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[:len(w) - words + 1].tolist(), ends[words - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        block = hashes[at:at + (1 << 15)].astype("<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed 64-bit integer."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, schema)


def n_blocks(n_classes: int, max_bits: int) -> int:
    """The fewest blocks for which unrelated fingerprints seldom share a choice of ``blocks - max_bits``."""
    blocks = max_bits + 1
    while blocks < 16 and n_classes > 2 ** (64 * (blocks - max_bits) // blocks):
        blocks += 1
    return blocks


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Bit masks of all choices of ``blocks - max_bits`` blocks, as signed integers."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    part = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(part, blocks - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _distances(fp: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """The pivot table: a row per pivot, a column per fingerprint."""
    return np.stack([np.bitwise_count(fp ^ r) for r in refs]).astype(np.int8)


def _survivors(table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    for coordinate in table:
        near = np.abs(coordinate[i] - coordinate[j]) <= max_bits
        i, j = i[near], j[near]
        if not len(i):
            break
    return i, j


def _small_groups(fp, group, table, max_bits):
    """Links between members of the same group, all groups of a batch at once."""
    out = []
    step = 1
    while step < len(fp):
        i = np.flatnonzero(group[:-step] == group[step:])
        if not len(i):
            break
        i, j = _survivors(table, i, i + step, max_bits)
        linked = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        out.append((fp[i[linked]], fp[j[linked]]))
        step += 1
    return out


def _walk(fp, table, max_bits):
    """Spanning links of one large group: reached members leave the set that is still compared."""
    out = []
    left = np.arange(len(fp))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            _, j = _survivors(table, np.full(len(left), at), left, max_bits)
            found = j[np.bitwise_count(fp[j] ^ fp[at]) <= max_bits]
            if len(found):
                out.append((np.full(len(found), fp[at], np.uint64), fp[found]))
                left = left[~np.isin(left, found, assume_unique=True)]
                frontier.extend(found.tolist())
    return out


def meeting_places(classes: DataFrame, blocks: int, max_bits: int, hot_place: int = HOT_PLACE) -> DataFrame:
    """``(fp, place)``: every fingerprint in each place where it may meet a partner.

    A place is the hash of a choice of blocks and the bits there; a place above
    ``hot_place`` members is replaced by its parts under choices of finer blocks.
    """

    def choices(n: int):
        return F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")))
                         for i, m in enumerate(block_masks(n, max_bits))])

    dealt = classes.select("fp", F.explode(choices(blocks)).alias("place"))
    hot = dealt.groupBy("place").count().where(F.col("count") > hot_place).select("place", F.lit(True).alias("hot"))
    seen = dealt.join(hot, "place", "left")
    finer = seen.where("hot").select("fp", "place", F.explode(choices(blocks + FINER_BLOCKS)).alias("part"))
    return seen.where("hot IS NULL").select("fp", "place").unionByName(
        finer.select("fp", F.xxhash64("place", "part").alias("place")))


def links(classes: DataFrame, max_bits: int = MAX_BITS, n_classes: int | None = None, hot_place: int = HOT_PLACE) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all within ``max_bits``.

    ``classes`` holds a distinct ``fp``.  Not every pair of a dense cluster is
    emitted, but every pair within ``max_bits`` is connected by emitted links.
    """
    n = classes.count() if n_classes is None else n_classes
    dealt = meeting_places(classes, n_blocks(n, max_bits), max_bits, hot_place) \
        .repartition("place").sortWithinPartitions("place")
    refs = pivots()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(fp, place):
            group = np.cumsum(np.concatenate(([True], place[1:] != place[:-1]))) - 1
            size = np.bincount(group)[group]
            out = []
            small = (size > 1) & (size <= SMALL_GROUP)
            if small.any():
                f = fp[small]
                out += _small_groups(f, group[small], _distances(f, refs), max_bits)
            for g in np.unique(group[size > SMALL_GROUP]):
                f = fp[group == g]
                out += _walk(f, _distances(f, refs), max_bits)
            a = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.uint64)
            b = np.concatenate([x for _, x in out]) if out else np.empty(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held: list = []  # the last place of a batch may go on in the next
        for batch in batches:
            fp, place = (batch.column(i).to_numpy() for i in range(2))
            if not len(fp):
                continue
            changes = np.flatnonzero(place[1:] != place[:-1]) + 1
            if held and held[-1][1][-1] != place[0]:
                changes = np.concatenate(([0], changes))
            if len(changes):
                held.append((fp[:changes[-1]], place[:changes[-1]]))
                fps, places = (np.concatenate(x) for x in zip(*held))
                held = []
                yield linked(fps.view(np.uint64), places)
            last = changes[-1] if len(changes) else 0
            held.append((fp[last:], place[last:]))
        if held:
            fps, places = (np.concatenate(x) for x in zip(*held))
            yield linked(fps.view(np.uint64), places)

    return dealt.select("fp", "place").mapInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is 16 lower-case hex digits; a text without words (null
    included) has fingerprint zero and is linked like any other.  Documents whose
    fingerprints differ in at most ``max_bits`` bits are linked; ``component_id``
    is the smallest id reachable over links, null ids aside (null if there is no
    other).  Repeated rows get equal results; an empty table gives an empty one.
    """
    prints = written(fingerprints(pick(docs, doc_id=id_col, text=text_col), words), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    found = written(links(classes.select("fp"), max_bits), "links")
    nodes = connected_components(found).withColumnRenamed("node", "fp")
    rooted = classes.join(nodes, "fp")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = rooted.join(least, "root").select("fp", "component_id")
    labelled = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id"))
    return prints.join(written(labelled, "labels"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", words: int = SHINGLE_WORDS,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns.

    Of equal ids the first row stays; a null id only where the component has no other.
    """

    def decide(rows: DataFrame, number: str) -> DataFrame:
        named = pick(rows, doc_id="doc_id", row=number, text=text_col).select(
            F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row").alias("doc_id"), "text")
        found = near_duplicates(named, words=words, max_bits=max_bits)
        return found.where("doc_id.row = component_id.row").select("doc_id.row")

    return keep_rows(docs, decide)
