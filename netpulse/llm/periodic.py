"""Periodic runs in word sequences by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``min_words`` and
``MIN_EXPONENT`` periods long, that no neighbouring word extends.  Texts are whole in
their row, so nothing is shuffled: the words of many texts become one array of numbers
(a number of its own ends each text) and are searched together.

* Short periods, below ``SHORT``: for each lag the array is compared with itself.  Only
  every ``STRIDE``-th place is looked at first; a run leaves two such places in a row.
* Longer periods, scale by scale, q in ``[Q, 3Q/2)``: hashes of ``Q // 2`` words, and in
  each window of ``3Q/2`` of them the smallest.  Inside a run the windows at i and i + q
  hold the same hashes, so their minima lie q apart: pairs of equal minima at a distance
  of this scale are the seeds.  Hashes of stretches that are periodic at a third of
  their length or less (they lie in runs already found) are left out; every window of a
  run at this scale has others, by the periodicity lemma, and others recur only beyond
  a sixth of Q, so a minimum has a handful of partners whatever the text.

A seed is extended both ways by comparing words; two runs of the same words are one
run, the one with the smaller period, which is found first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, text_bytes

#: Smallest run: words, and periods.
MIN_WORDS, MIN_EXPONENT = 24, 3
#: Periods below this are found by direct lag scans.
SHORT = 48
#: Places looked at first in a lag scan: half the shortest stretch of equal words that a short run leaves.
STRIDE = 8
#: Words searched together; a longer text is searched by itself.
WORDS_AT_ONCE = 1_000_000

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: bytes) -> list[bytes]:
    return _WORDS.findall(text)


def _extend(a: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """The stretch ``[lo, hi)`` around p on which ``a[i] == a[i + q]``."""
    lo, hi, step = p, p + 1, 64
    while True:  # to the right
        top = min(hi + step, len(a) - q)
        bad = np.flatnonzero(a[hi:top] != a[hi + q:top + q])
        if len(bad):
            hi += int(bad[0])
            break
        hi = max(hi, top)
        if top >= len(a) - q:
            break
        step *= 2
    step = 64
    while lo > 0:  # to the left
        low = max(lo - step, 0)
        bad = np.flatnonzero(a[low:lo] != a[low + q:lo + q])
        if len(bad):
            lo = low + int(bad[-1]) + 1
            break
        lo, step = low, step * 2
    return lo, hi


class _Found:
    """Runs found so far, by extent; the first period found for an extent is its smallest."""

    def __init__(self, a: np.ndarray, min_words: int):
        self.a, self.min_words = a, min_words
        self.runs: dict[tuple[int, int], int] = {}

    def seeds(self, q: int, places: list[int]) -> None:
        """Extend pairs ``(p, p + q)`` of equal words, p ascending."""
        done = -1
        for p in places:
            if p < done:
                continue
            lo, hi = _extend(self.a, p, q)
            done = hi
            if hi + q - lo >= max(self.min_words, MIN_EXPONENT * q):
                self.runs.setdefault((lo, hi + q), q)


def _lag_scans(a: np.ndarray, found: _Found) -> None:
    marks = a[::STRIDE]
    for q in range(1, min(SHORT, len(a) // MIN_EXPONENT + 1)):
        ahead = a[q::STRIDE]
        same = marks[:len(ahead)] == ahead
        both = np.flatnonzero(same[:-1] & same[1:])
        if len(both):
            found.seeds(q, (both * STRIDE).tolist())


def _hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A polynomial hash of every k words in a row, by doubling: equal words give equal hashes."""
    n = len(words) - k + 1
    out, have, at = np.zeros(n, np.uint64), 0, words
    power, size = np.uint64(0x9E3779B97F4A7C15), 1
    bits = k
    with np.errstate(over="ignore"):
        while bits:
            if bits & 1:
                out = out * power + at[have:have + n]
                have += size
            bits >>= 1
            if bits:
                at = at[:len(at) - size] * power + at[size:]
                at ^= at >> np.uint64(29)
                power, size = power * power, size * 2
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.minimum(out, _NEVER - np.uint64(1))


def _sliding(x: np.ndarray, w: int, best: np.ufunc, fill: np.uint64) -> np.ndarray:
    """``best`` over every w values in a row, by running values inside blocks of w from both sides."""
    n = len(x) - w + 1
    padded = np.concatenate([x, np.full(-len(x) % w, fill, x.dtype)]).reshape(-1, w)
    left = best.accumulate(padded, axis=1).ravel()
    right = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(right[:n], left[w - 1:w - 1 + n])


def _scale(a: np.ndarray, mixed: np.ndarray, lowest: int, highest: int, found: _Found) -> None:
    """Runs with periods in ``[lowest, highest)``."""
    k, w = lowest // 2, highest - 1
    if len(a) < 2 * k + w:
        return
    h = _hashes(mixed, k)
    for (lo, hi), q in found.runs.items():
        if MIN_EXPONENT * q <= k <= hi - lo:
            h[lo:hi - k + 1] = _NEVER
    smallest = _sliding(h, w, np.minimum, _NEVER)
    # a place is a minimizer if its hash is the largest of the minima of the windows that hold it
    around = np.concatenate([np.zeros(w - 1, np.uint64), smallest, np.zeros(w - 1, np.uint64)])
    places = np.flatnonzero((h == _sliding(around, w, np.maximum, np.uint64(0))) & (h != _NEVER))
    places = places[np.argsort(h[places], kind="stable")]
    values = h[places]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for lag in range(1, len(places)):
        apart = places[lag:] - places[:-lag]
        near = (values[lag:] == values[:-lag]) & (apart < highest)
        if not near.any():
            break
        at = np.flatnonzero(near & (apart >= lowest))
        pairs.append((apart[at], places[at]))
    if pairs:
        q, p = (np.concatenate(x) for x in zip(*pairs, strict=True))
        equal = a[p] == a[p + q]
        q, p = q[equal], p[equal]
        order = np.lexsort((p, q))
        q, p = q[order], p[order]
        cuts = np.flatnonzero(np.diff(q)) + 1
        for qs, ps in zip(np.split(q, cuts), np.split(p, cuts), strict=True):
            if len(qs):
                found.seeds(int(qs[0]), ps.tolist())


def find_runs(a: np.ndarray, lengths: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of texts laid end to end in ``a``, by start, then period.

    ``lengths`` are the texts' lengths, longest first, each with the number that ends
    it; so the texts long enough for a scale are the first part of the array.
    ``min_words`` is 24 at least: the scans rely on it.
    """
    if min_words < MIN_WORDS:
        raise ValueError(f"runs of fewer than {MIN_WORDS} words are not searched for")
    found = _Found(a, min_words)
    _lag_scans(a, found)
    with np.errstate(over="ignore"):
        mixed = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
    sizes, upto = -np.array(lengths), np.concatenate([[0], np.cumsum(lengths)])
    low = SHORT
    while cut := int(upto[np.searchsorted(sizes, -MIN_EXPONENT * low)]):
        high = low + low // 2
        _scale(a[:cut], mixed[:cut], low, high, found)
        low = high
    return sorted((lo, hi - lo, q) for (lo, hi), q in found.runs.items())


def _runs_of_texts(texts: list[list[bytes]], min_words: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, all searched as one array."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers: dict[bytes, int] = {}
    parts, starts = [], []
    for i in order:
        starts.append(len(parts))
        parts += [numbers.setdefault(w, len(numbers)) for w in texts[i]]
        parts.append(-1 - i)  # ends the text: no run goes over it
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = find_runs(np.array(parts, np.int64), [len(texts[i]) + 1 for i in order], min_words)
    for at, (start, length, q) in zip(np.searchsorted(starts, [r[0] for r in found], side="right") - 1, found, strict=True):
        out[order[at]].append((start - starts[at], length, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside every run's repetitions: a run keeps its first period unless another run drops it."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, runs, collapsed)`` of each document, one row per row.

    ``runs`` is an array of ``(start, length, period)`` in words, by start, then period;
    ``collapsed`` the text without the words that a run holds after its first period,
    joined by single spaces.  A null text has no words and gives an empty text; texts of
    any length are read whole, and a row is answered from its text alone, so repeated
    rows give repeated results and an empty table an empty one.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("runs", T.ArrayType(run)),
                           T.StructField("collapsed", T.StringType())])
    run_arrow = pa.struct([(c, pa.int64()) for c in run.names])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(ids, texts):
            runs = _runs_of_texts(texts, min_words)
            collapsed = [b" ".join(collapse(w, r)).decode() for w, r in zip(texts, runs, strict=True)]
            named = [[dict(zip(run.names, x, strict=True)) for x in r] for r in runs]
            return pa.RecordBatch.from_arrays([ids, pa.array(named, pa.list_(run_arrow)), pa.array(collapsed, pa.string())],
                                              names=schema.names)

        for b in batches:
            first, held, n = 0, [], 0
            for at, text in enumerate(text_bytes(b.column(1))):
                words = words_of(text)
                if held and n + len(words) > WORDS_AT_ONCE:
                    yield answer(b.column(0).slice(first, len(held)), held)
                    first, held, n = at, [], 0
                held.append(words)
                n += len(words)
            if held:
                yield answer(b.column(0).slice(first, len(held)), held)

    return docs.mapInArrow(search, schema)


def plant_runs(docs: DataFrame) -> DataFrame:
    """Every tenth ``(doc_id, text)`` with its words from some place on made periodic; a null id or text stays.

    With ``h = crc32(doc_id)`` and ``g = h div 10``: if h divides by 10 and the text has
    n words, each word i from ``a = g mod n`` on becomes word ``a + (i - a) mod p``,
    ``p = 1 + (n - a) div (3 + g mod 8)``.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    placed = chosen.select("doc_id", "text", "words", F.when(n > 0, (F.col("g") % n).cast("int")).alias("a"), "g")
    p = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    tail = F.slice("words", F.col("a") + 1, p)
    whole = F.flatten(F.array_repeat(tail, F.ceil((n - F.col("a")) / p).cast("int")))
    made = F.concat(F.slice("words", 1, F.col("a")), F.slice(whole, 1, n - F.col("a")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))
