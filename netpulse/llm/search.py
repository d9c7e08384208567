"""Ranked lexical search by presence masks: the ten best documents of every item.

The items are taken in batches of bounded size; a batch's terms are what every task
knows.  One pass over the texts writes, per document, its length in terms and how often
it holds each term of the batch; document frequencies and lengths are aggregates of
that table.  A second pass reads the table in blocks of documents.  In a block each
term is a bit: the bits of an item's terms are or-ed onto the documents that hold them,
and the documents fall into groups of equal masks.  A mask's best possible score is the
sum of its terms' best contributions, so the groups are evaluated from the best mask
down until ten scores lie above what any mask left could reach.  Each task keeps ten
documents an item over all its blocks, and a ranking filter merges them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, text_bytes, written

#: Results an item.
TOP = 10
#: Distinct terms of all items of a batch together (an item with more is a batch of its own).
BATCH_TERMS = 200_000
#: Documents and postings that a block holds at most (a document with more is a block of its own).
BLOCK_DOCS, BLOCK_POSTINGS = 65_536, 4_000_000
#: Terms whose bits go into one refinement of the masks.
MASK_BITS = 40

#: Bytes between terms become spaces: everything in ASCII that is no letter or digit.
_SPACED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: maximal runs of ASCII letters, digits and other code points, A-Z lower-cased."""
    return text.lower().translate(_SPACED).split()


def _item_batches(items: DataFrame, limit: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    batch: list[tuple[object, list[bytes]]] = []
    held: set[bytes] = set()
    for row in items.toLocalIterator():
        words = sorted(set(terms_of((row[1] or "").encode())))
        if not words:
            continue
        if batch and len(held.union(words)) > limit:
            yield batch
            batch, held = [], set()
        batch.append((row[0], words))
        held.update(words)
    if batch:
        yield batch


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of every ``(doc_id, text)`` with a term: its terms, and the counts of those listed."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, terms, tfs, keep = [], [], [], []
            for at, text in enumerate(text_bytes(b.column(1))):
                words = terms_of(text)
                if words:
                    counts = Counter(words)
                    found = [(vocabulary[w], counts[w]) for w in counts.keys() & vocabulary.keys()]
                    lengths.append(len(words))
                    terms.append([t for t, _ in found])
                    tfs.append([c for _, c in found])
                    keep.append(at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], names=schema.names)

    return docs.mapInArrow(count, schema)


def mask_groups(n_docs: int, holders: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents that hold a term, their groups of equal masks, and a document of each group.

    ``holders`` has the documents of each term.  Bits are or-ed onto the documents,
    ``MASK_BITS`` terms at a time, each time refining the groups so far.
    """
    any_bit = np.zeros(n_docs, bool)
    for h in holders:
        any_bit[h] = True
    docs = np.flatnonzero(any_bit)
    group = np.zeros(len(docs), np.int64)
    bits = np.zeros(n_docs, np.int64)
    first = np.zeros(0, np.int64)
    for lo in range(0, len(holders), MASK_BITS):
        bits[docs] = 0
        for j, h in enumerate(holders[lo:lo + MASK_BITS]):
            bits[h] |= np.int64(1) << j
        # a block has few enough documents for the group so far beside the new bits
        _, first, group = np.unique((group << MASK_BITS) | bits[docs], return_index=True, return_inverse=True)
    return docs, group, first


def best_of_block(n_docs: int, holders: list[np.ndarray], gains: list[np.ndarray], ids_order: np.ndarray, top: int,
                  floor: tuple[int, int] = (0, 0)) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the best ``top`` of a block, at least; a score below ``floor`` may be left out.

    ``holders[j]`` are the documents of term j, ascending, ``gains[j]`` what it adds to
    their scores.  ``ids_order`` ranks the documents by id for equal scores.
    """
    docs, group, first = mask_groups(n_docs, holders)
    if not len(docs):
        return docs, docs
    bound = np.zeros(len(first), np.int64)
    for h, g in zip(holders, gains, strict=True):
        if len(h):
            at = np.minimum(np.searchsorted(h, docs[first]), len(h) - 1)
            bound += np.where(h[at] == docs[first], g.max(), 0)
    order = np.argsort(-bound, kind="stable")
    by_group = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[by_group], np.arange(len(first) + 1))
    sizes = np.diff(starts)[order]
    upto = np.cumsum(sizes)
    found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, want = 0, 64
    least, enough = floor
    while at < len(order) and not (enough and bound[order[at]] < least):
        to = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + want)) + 1
        part = np.concatenate([by_group[starts[g]:starts[g + 1]] for g in order[at:to]])
        members = docs[part]
        s = np.zeros(len(members), np.int64)
        for h, g in zip(holders, gains, strict=True):
            if len(h):
                i = np.minimum(np.searchsorted(h, members), len(h) - 1)
                s += np.where(h[i] == members, g[i], 0)
        found, scores = np.concatenate([found, members]), np.concatenate([scores, s])
        best = np.lexsort((ids_order[found], -scores))[:top]
        found, scores = found[best], scores[best]
        if len(found) == top:
            # a mask whose bound only equals the last score may still hold a smaller id
            least, enough = max(least, int(scores[-1])), 1
        at, want = to, want * 4
    return found, scores


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for b in batches:
        at = 0
        sizes = np.diff(b.column(2).offsets.to_numpy())
        while at < b.num_rows:
            room = np.searchsorted(np.cumsum(sizes[at:]), BLOCK_POSTINGS - postings, side="right")
            n = int(min(b.num_rows - at, BLOCK_DOCS - docs, room))
            if n <= 0 and held:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
                continue
            n = max(n, 1)
            held.append(b.slice(at, n))
            docs, postings, at = docs + n, postings + int(sizes[at:at + n].sum()), at + n
    if held:
        yield pa.Table.from_batches(held)


def best_documents(counted: DataFrame, batch: list[tuple[object, list[bytes]]], vocabulary: dict[bytes, int],
                   weights: np.ndarray, n_docs: int, n_terms: int, item_type: T.DataType, top: int) -> DataFrame:
    """``(item, item_id, doc_id, score)``: each task's best ``top`` documents of every item of a batch."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type),
                           T.StructField("doc_id", counted.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
    wanted = [(i, [t for t in (vocabulary[w] for w in words) if weights[t] > 0]) for i, (_, words) in enumerate(batch)]
    item_ids = [item_id for item_id, _ in batch]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, tuple, object]]] = {}
        for block in _blocks(batches):
            block = block.combine_chunks()
            ids, n = block.column(0).to_pylist(), block.column(1).to_numpy()
            m = 10 + (90 * n * n_docs) // n_terms
            lists = block.column(2).chunk(0) if block.column(2).num_chunks else pa.array([], pa.list_(pa.int32()))
            terms = lists.flatten().to_numpy()
            tfs = block.column(3).chunk(0).flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            gain = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]) * weights[terms]
            by_term = np.argsort(terms, kind="stable")
            terms, doc, gain = terms[by_term], doc[by_term], gain[by_term]
            keyed = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
            rank = np.empty(len(ids), np.int64)
            rank[keyed] = np.arange(len(ids))
            for item, ts in wanted:
                cuts = [slice(*np.searchsorted(terms, (t, t + 1))) for t in ts]
                held = best.get(item, [])
                floor = (-held[-1][0], 1) if len(held) == top else (0, 0)
                found, scores = best_of_block(len(ids), [doc[c] for c in cuts], [gain[c] for c in cuts], rank, top, floor)
                new = [(-int(s), (ids[d] is None, ids[d] if ids[d] is not None else 0), ids[d])
                       for d, s in zip(found, scores, strict=True) if s > 0]
                if new:
                    best[item] = sorted(held + new, key=lambda x: x[:2])[:top]
        rows = [(i, item_ids[i], r[2], -r[0]) for i, held in best.items() for r in held]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return counted.mapInArrow(search, schema)


def ranked_search(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", top: int = TOP, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item with the highest score above 0.

    Integer BM25: a term weighs ``floor(1000 ln((2N+2)/(2df+1)))`` and adds that times
    ``10^9 tf div (1000 tf + 8m)``, with ``m = 10 + 90 n N div L`` for a document of n
    terms; N documents have a term, L terms in all.  Equal scores go by ascending
    ``doc_id``, null last.  A null or empty text has no terms and is no document here;
    an item without terms has no rows.  Every row of the documents counts for itself,
    and a repeated item row repeats its results.  Texts of any length are read whole.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    items = pick(items, item_id=item_id, text=item_text)
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType
    out = None
    for number, batch in enumerate(_item_batches(items, batch_terms)):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in batch for w in words}))}
        counted = written(term_counts(docs, vocabulary), "terms")
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term of the batch
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        part = best_documents(counted, batch, vocabulary, weights, n_docs, max(n_terms, 1), item_type, top)
        w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top) \
            .select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        schema = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
        out = spark.createDataFrame([], schema)
    return out
