"""Periodic runs, ranked search and line de-duplication against brute force, also on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import plan_text
from helpers_llm import DOCS, ODD_TEXTS, WORD, documents, lower
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse.llm import line_dedup, periodic, search
from netpulse.llm.common import read_table
from netpulse.llm.queries import QUERIES


def brute_runs(words, min_words=24):
    """Every lag compared with the whole text; of one extent the smallest period counts."""
    a, out = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.zeros(0, int), {}
    for q in range(1, len(words) // 3 + 1):
        same = np.concatenate([[False], a[:-q] == a[q:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for lo, hi in zip(edges[::2], edges[1::2], strict=True):
            if hi + q - lo >= max(min_words, 3 * q):
                out.setdefault((int(lo), int(hi) + q), q)
    return sorted((lo, hi - lo, q) for (lo, hi), q in out.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    words = planted(doc_id, words) if doc_id is not None else words
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def run_texts(seed=1):
    """Texts with runs of many periods, also inside and beside each other, over small and large vocabularies."""
    rnd, texts = random.Random(seed), []
    for size in (1, 2, 3, 30, 3000):
        for _ in range(14):
            words = []
            while len(words) < rnd.choice([30, 200, 900, 1500]):
                period = [f"w{rnd.randrange(size)}" for _ in range(rnd.choice([1, 2, 5, 7, 8, 12, 47, 48, 71, 72, 110, 200]))]
                if rnd.random() < 0.4:  # a period that holds runs itself
                    period += period[:3] * rnd.randrange(8, 30)
                words += period * rnd.choice([1, 2, 3, 4]) + period[:rnd.randrange(len(period) + 1)]
                words += [f"w{rnd.randrange(size)}" for _ in range(rnd.randrange(40))]
            texts.append(" ".join(words))
    return texts


def test_runs_equal_brute_force(spark, tmp_path):
    texts = ODD_TEXTS + run_texts() + ["a " * 40 + "b", "x y " * 12, "x y " * 11 + "x", "a b c d e f g h " * 3, "a b c d e f g h i " * 2]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "k " * 30, "en", "s", 0), (3, texts[40], "en", "s", 0), (3, texts[40], "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == names and dict(got.dtypes)["exponent_milli"] == "bigint"
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    want = sorted((brute_row(r[0], r[1]) for r in rows), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    assert sum(r[1] for r in want) > 200 and any(r[4] and r[4] > 72 for r in want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=90), st.integers(1, 5)), min_size=1, max_size=8))
def test_runs_of_any_array(parts):
    words = [b"%d" % w for block, times in parts for w in block * times]
    assert periodic._runs_of_texts([words, words[::-1], []], 24) == [brute_runs(words), brute_runs(words[::-1]), []]


def test_runs_of_long_texts_take_time_in_proportion():
    rnd = random.Random(5)
    period = [b"%d" % rnd.randrange(5000) for _ in range(40_000)]
    words = period * 4 + [b"z"] * 60_000 + [b"a", b"b", b"c"] * 20_000
    found = periodic._runs_of_texts([words], 24)[0]
    assert (0, 160_000, 40_000) in found and (160_000, 60_000, 1) in found and (220_000, 60_000, 3) in found


def test_runs_refuse_a_limit_the_scans_cannot_hold(spark):
    with pytest.raises(ValueError):
        periodic.find_runs(np.arange(5), [5], 10)


def test_collapsed_text_and_empty_table(spark):
    docs = documents(spark, ["go " + "a b " * 20 + "end", None]).withColumn("DOC_ID_", F.lit(1)).withColumn("Text2", F.lit("x"))
    got = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert got[0].collapsed == "go a b end" and [tuple(r) for r in got[0].runs] == [(1, 40, 2)]
    assert got[1].collapsed == "" and got[1].runs == []
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, top=10):
    counts = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                    for w in set(TERM.findall(lower(text))) if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:top])]
    return out


def _found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("batch_terms", [200_000, 30])
def test_search_equals_brute_force(spark, batch_terms, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 37)
    rnd = random.Random(3)
    vocabulary = [f"t{i}" for i in range(90)]
    texts = ODD_TEXTS + [" ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(90)], k=rnd.randrange(1, 60))) for _ in range(300)]
    texts += texts[40:60] * 3  # equal scores
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "t1 t2"), (7, "t3 t4"), (7, "t3 t4")]
    items = [(0, "t1 T2 t3"), (1, None), (2, ""), (3, "...", ), (4, " ".join(vocabulary)), (5, "nowhere"), (6, "the é 中文 Σ"),
             (7, " ".join(vocabulary[40:80])), (7, "t1 t1 t1"), (None, "quick fox"), *[(10 + i, f"t{i} t{i + 1}, t{2 * i}!") for i in range(20)]]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("Item_id", F.lit(1)).repartition(3)
    want = sorted(brute_search(docs, items), key=str)
    got = search.ranked_search(df, spark.createDataFrame(items, "item_id long, text string"), batch_terms=batch_terms)
    assert _found(got) == want and len(want) > 150


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.ranked_search(docs.limit(0), items).count() == 0
    got = search.ranked_search(docs, items.limit(0))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 95), max_size=30), min_size=1, max_size=40))
def test_groups_hold_equal_masks(docs):
    holders = [np.array([i for i, d in enumerate(docs) if t in d], np.int64) for t in range(96)]
    members, group, first = search.mask_groups(len(docs), holders)
    masks = [frozenset(docs[i]) for i in members]
    assert members.tolist() == [i for i, d in enumerate(docs) if d] and len(set(masks)) == len(first)
    assert all(masks[i] == masks[first[g]] for i, g in enumerate(group))


def test_few_masks_are_evaluated():
    """A document with all terms and short length closes the search: weaker masks are never scored."""
    holders = [np.arange(0, 10_000, 1 + t) for t in range(5)]
    gains = [np.full(len(h), 1000 * (t + 1)) for t, h in enumerate(holders)]
    found, scores = search.best_of_block(10_000, holders, gains, np.arange(10_000), 10)
    assert sorted(found.tolist()) == [60 * i for i in range(10)] and set(scores.tolist()) == {15_000}


# ---------------------------------------------------------------- lines

def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is not None, i or 0)
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    keep = {k: max(ids, key=order) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if keep.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def line_texts():
    rnd = random.Random(4)
    shared = [f"Shared line number {i} of the boilerplate" for i in range(12)] + ["exactly twenty chars", "only nineteen chars", "é" * 20, "中" * 19]
    texts = []
    for i in range(120):
        lines = [rnd.choice(shared) if rnd.random() < 0.4 else f"own line {i} {j} with some more words" for j in range(rnd.randrange(12))]
        lines = [rnd.choice(["", " ", "\t\t", "\x0b"]) + (x.upper() if rnd.random() < 0.2 else x) + rnd.choice(["", "\r", "  "]) for x in lines]
        texts.append("\n".join(lines))
    texts += ["\n".join(["the same line over and over again"] * 5)] * 3 + ["\n\n\n", "A line in just two documents, no more"] * 2
    return texts


def test_lines_equal_brute_force(spark):
    texts = ODD_TEXTS + line_texts() + ["a very long shared line " * 4000 + "\nx"] * 4
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "exactly twenty chars\nnull id"), (None, "exactly twenty chars\nother null id"),
                                                    (5, "exactly twenty chars\nrepeated row"), (5, "exactly twenty chars\nrepeated row")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("TEXT_", F.lit("x")).withColumn("n_lines", F.lit(9))
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(df).collect()), key=str)
    assert got == sorted(brute_lines(rows), key=str)
    assert sum(r[2] for r in got) > 200


def test_lines_of_repeated_ids_and_nulls_count_one_document(spark):
    line = "a line that is long enough"
    rows = [(None, line), (None, line + "\nx"), (4, line), (4, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.n_dropped == 0 for r in line_dedup.dedup_lines(df).collect())  # two documents
    got = line_dedup.dedup_lines(df.unionByName(spark.createDataFrame([(2, line)], df.schema))).collect()
    assert sorted((str(r.doc_id), r.n_dropped) for r in got) == [("2", 1), ("4", 0), ("4", 0), ("None", 1), ("None", 1)]


def test_bitmaps_are_runs_of_kept_lines(spark):
    rows = [(i, f"first {i}\nboilerplate of the whole site\nmiddle\nboilerplate of the whole site\nlast") for i in range(4)]
    bitmaps = line_dedup.line_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_dropped, [tuple(k) for k in r.keep]) for r in bitmaps] == \
        [(i, 2, [(0, 1), (2, 1), (4, 1)]) for i in range(3)]
    empty = spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_are_dealt_by_range_without_python(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = line_dedup.line_rows(docs.select("doc_id", "text"))
    plan = plan_text(line_dedup.first_occurrences(rows, 3))
    assert "rangepartitioning(digest" in plan and "hashpartitioning" not in plan
    assert not re.search("Python|Pandas|Arrow", plan + plan_text(line_dedup.dedup_lines(docs)))
