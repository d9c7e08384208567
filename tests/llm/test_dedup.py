import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers_llm import ODD_TEXTS, documents, lower, near_classes, simhash
from pyspark.sql import functions as F

from netpulse.llm.components import connected_components
from netpulse.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, heavy_groups, misra_gries, text_digests
from netpulse.llm.simhash import block_masks, drop_near_duplicates, fingerprint, links, meeting_places, n_blocks, near_duplicates


def exact_brute(texts):
    norm = [lower(t) for t in texts]
    size, keep = Counter(norm), {t: i for i, t in enumerate(norm)}
    return {i: (keep[t], size[t], keep[t] == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)}


@pytest.mark.parametrize("share", [0.5, 0.01])
def test_exact_matches_brute_force(spark, share):
    texts = ODD_TEXTS + ["Same Text"] * 40 + ["same text"] * 3 + ["SAME TÉXT", "same tÉxt", "same téxt", "Other"]
    got = exact_duplicates(documents(spark, texts), share=share).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == exact_brute(texts)


def test_exact_repeated_rows_nulls_and_extra_columns(spark):
    rows = [(1, "x", "a"), (1, "x", "b"), (None, "x", "c"), (None, "lone", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string").withColumn("digest", F.lit(1)) \
        .select("*", F.lit("clash").alias("TEXT"))
    got = exact_duplicates(df).collect()
    same = [r for r in got if r.group_size == 3]
    assert len(same) == 3 and sum(r.kept for r in same) == 1 and {r.keep_id for r in same} == {1}
    assert [(r.keep_id, r.kept) for r in got if r.group_size == 1] == [(None, True)]
    assert exact_duplicates(df.limit(0)).count() == 0


def test_exact_filter_keeps_whole_rows(spark):
    docs = documents(spark, ["a", "A", "b", None, ""])
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_misra_gries_bounds_and_heavy_groups(spark):
    rng = random.Random(1)
    texts = [f"t{rng.randrange(400)}" for _ in range(3000)] + ["hot"] * 1500
    digests = text_digests(documents(spark, texts).repartition(7)).cache()
    true = Counter(hashlib.sha256(t.encode()).digest() for t in texts)
    k = 20
    for r in misra_gries(digests, k).collect():
        assert r.estimate <= true[bytes(r.digest)] <= r.estimate + len(texts) / (k + 1)
    heavy = heavy_groups(digests, 0.1).collect()
    assert [(bytes(r.digest), r.group_size) for r in heavy] == [(hashlib.sha256(b"hot").digest(), 1500)]


def test_fingerprint_matches_brute_force():
    for t in ODD_TEXTS + ["The Cat sat on THE mat", "ÀB C d e"]:
        assert fingerprint((t or "").encode()) == simhash(t)


def test_fingerprint_equals_the_jvm_hash(spark):
    text = "some four word shingles here"
    words = text.split()
    sh = [" ".join(words[i:i + 4]) for i in range(2)]
    jvm = [spark.range(1).select(F.xxhash64(F.lit(s))).first()[0] & (1 << 64) - 1 for s in sh]
    assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in jvm) > 2)


def test_hot_meeting_place_is_dealt_again_and_loses_no_link(spark):
    rng = np.random.default_rng(5)
    # one place for all under the first choice: equal low bits; a few of them are near others
    fps = (rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(13)) | np.uint64(77)
    near = fps[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    fps = np.unique(np.concatenate([fps, near])).view(np.int64)
    frame = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    largest = {hot: meeting_places(frame, 5, 4, hot).groupBy("place").count().agg(F.max("count")).first()[0] for hot in (10**6, 100)}
    assert largest[10**6] >= 3000 and largest[100] < 100
    u = fps.view(np.uint64)
    pairs = {(a, b) for i, a in enumerate(u) for b in u[i + 1:][np.bitwise_count(u[i + 1:] ^ a) <= 4]}
    want = {frozenset(p) for p in pairs}
    got = {frozenset((r.a % 2**64, r.b % 2**64)) for r in links(frame, 4, 1000, hot_place=100).collect()}
    assert got <= want and len(want) >= 250
    root = {int(x): int(x) for x in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in got:
        root[find(a)] = find(b)
    assert all(find(int(a)) == find(int(b)) for a, b in pairs)


def test_block_masks_cover_every_error_pattern():
    rng = random.Random(3)
    for n in (10, 10_000, 10**7, 10**10):
        masks = [m & (1 << 64) - 1 for m in block_masks(n_blocks(n, 4), 4)]
        for _ in range(200):
            flips = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("n_classes", [None, 10**7])
def test_links_connect_exactly_what_pairs_connect(spark, n_classes):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(fps)[:6]:
        for _ in range(rng.choice([3, 40, 150])):  # also clusters beyond a small group
            x = centre
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps.add(0)
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = links(frame, 4, n_classes).collect()
    for r in found:
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4
    place = {int(np.uint64(f).astype(np.int64)): i for i, f in enumerate(fps)}
    from helpers_llm import classes_of
    assert classes_of([(place[r.a], place[r.b]) for r in found], len(fps)) == near_classes(fps)


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    extra = spark.createDataFrame([(1000, 1001), (1001, 1002), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges.unionByName(extra)).collect()}
    assert got == {**dict.fromkeys(range(300), 0), 1000: 1000, 1001: 1000, 1002: 1000}
    assert connected_components(edges.limit(0)).count() == 0


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    texts = list(ODD_TEXTS)
    for _ in range(12):
        base = [rng.choice(words) for _ in range(300)]
        texts.append(" ".join(base))
        for _ in range(6):
            w = list(base)
            w[rng.randrange(300)] = "changed"
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else "  ".join(w))
    rng.shuffle(texts)
    got = {r.doc_id: r for r in near_duplicates(documents(spark, texts).withColumn("fp", F.lit(1))).collect()}
    fps = [simhash(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == near_classes(fps)
    kept = drop_near_duplicates(documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(near_classes(fps)))


def test_near_duplicates_edge_rows(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "quite another text of words"), (3, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 7), (3, 3), (7, 7), (7, 7)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
