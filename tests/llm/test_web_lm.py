import base64
import hashlib
import math
import random
from collections import Counter

import pytest
from helpers_llm import ODD_TEXTS, documents, lower
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse.llm import warc
from netpulse.llm.common import read_table
from netpulse.llm.lm import blocks, counts_elsewhere, ngram_rows, pack, stupid_backoff, unpack
from netpulse.llm.url_filter import RULES, filter_urls, labelled_urls, train_url_model
from netpulse.session import scratch_path

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


# ---------------------------------------------------------------- archives

def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


HTML = ["<p>same</p>"] * 5 + ["", None, "", "ü€𝄞", "x" * 3_000_000, "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n", "<p>other</p>"]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_round_trip(spark, min_bytes):
    rows = [(100 - i, None if i == 3 else f"http://h/{i}\r\nX: y", h) for i, h in enumerate(HTML)]
    source = pages(spark, rows).select("*", F.lit("clash").alias("digest"), F.lit(1).alias("HTML"))
    index = warc.write_archives(source, scratch_path(spark, "warc"), min_bytes)
    got = {r.page_id: r for r in warc.read_archives(index, T.LongType()).collect()}
    assert len(got) == len(rows) and index.count() == len(rows)
    for page_id, url, html in rows:
        body = (html or "").encode()
        first = min(p for p, _, h in rows if (h or "") == (html or ""))
        r = got[page_id]
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = first != page_id and len(body) >= min_bytes
        assert (r.record_type, r.refers_to) == (("revisit", first) if again else ("response", None))
        assert r.payload is None if again else bytes(r.payload) == body
        assert r.url == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    for e in index.collect():  # a record by its identifier, through the seek table
        head, n, _ = warc.read_record(e.bundle, e.frame, e.offset)
        assert head["WARC-Record-ID"] == e.record_id and n == got[int(head["X-Page-ID"])].payload_bytes


def test_archives_frames_and_bundles_are_bounded(spark, monkeypatch):
    writer = None
    folder = scratch_path(spark, "warc")
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
    writer = warc._BundleWriter(folder, "t")
    records = [warc.warc_record(i, f"http://h/{i}", b"payload %d" % i * 10, warc.payload_digest(b"payload %d" % i * 10)) for i in range(40)]
    places = [writer.add(r) for r in records]
    writer.close()
    assert len({p[0] for p in places}) > 2 and max(p[1] for p in places) > 1
    for i, (bundle, frame, offset, _) in enumerate(places):
        assert warc.read_record(bundle, frame, offset)[2] == b"payload %d" % i * 10


def test_archives_empty_repeated_and_null_rows(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0
    rows = [(1, "u", "x"), (1, "u", "x"), (2, "u", "x"), (None, "u", "x"), (None, None, "alone")]
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages(spark, rows)).collect())
    assert got == {(1, "response", None): 2, (2, "revisit", 1): 1, (None, "revisit", 1): 1, (None, "response", None): 1}


def test_a_damaged_payload_is_noticed():
    r = warc.warc_record(1, "u", b"abc", warc.payload_digest(b"abd"))
    with pytest.raises(ValueError):
        warc.parse_record(r)


# ---------------------------------------------------------------- url filter

def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[at:]
    return lower(rest[:at]), tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]


def rule_of(host, path):
    fit = []
    for verdict, rule in RULES:
        name, _, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
            fit.append((-len(rule), rule, verdict))
    return min(fit)[1:] if fit else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/1", "https://example.net/en", "https://x.example.net/fr/", "ftp://net",
        "http://net/", "http://subnet/x", "http://a.net?x=/en/", "http://a.net/#y", "http://q.example.com/de/1?z", "http://example.com/DE/",
        "http://b.org/fr/a", "http://org/fr", "http://ÉX.ORG/fr/é", "a://b://c.net/", "http://u.net/en/\nx", "x" * 5000 + "://h.net/" + "p" * 5000]


def test_urls_and_rules_match_brute_force(spark):
    model = train_url_model(labelled_urls(spark))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(0, None)], "page_id long, url string") \
        .select("*", F.lit(1).alias("host"), F.lit(2).alias("features"), F.lit(3).alias("URL"))
    got = filter_urls(df, model).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path) == split_url(URLS[r.page_id])
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule
        assert r.verdict == (verdict or ("block" if r.model_blocks else "allow"))
    assert filter_urls(df.limit(0), model).count() == 0


def test_url_model_on_urls_it_has_not_seen(spark):
    held = ["www.casino-royal.example.com", "best-bets.example.org", "m.cheap-pills24.example.net", "adult-fun.example.com",
            "ads-tracker.example.org", "blog.spam-mail.example.net"]
    fine = ["www.botany.example.com", "blog.thernation.example.org", "m.heather.example.net", "tionsh.example.com", "physics.example.org"]
    model = train_url_model(labelled_urls(spark).where(~F.col("url").contains("casino-win")))
    df = spark.createDataFrame([(i, f"https://{h}/en/{i}") for i, h in enumerate(held + fine)], "page_id long, url string")
    got = {r.page_id: r.model_blocks for r in filter_urls(df, model, rules=[]).collect()}
    right = sum(got[i] == (i < len(held)) for i in got)
    assert right / len(got) >= 0.9


def test_url_filter_stays_on_the_jvm(spark):
    from helpers import plan_text
    df = read_table(spark, "/root/testdata/sf0.001", "pages")
    text = plan_text(filter_urls(df, train_url_model(labelled_urls(spark))))
    assert "Python" not in text and "Arrow" not in text


# ---------------------------------------------------------------- language model

def brute_scores(texts, order=3, backoff=0.4, min_count=1):
    docs = [lower(t).encode().split() for t in texts]
    counts = Counter(tuple(d[i:i + n]) for d in docs for n in range(1, order + 1) for i in range(len(d) - n + 1))
    total = sum(len(d) for d in docs)
    out = []
    for d in docs:
        s, given_up = 0.0, 0
        for i in range(len(d)):
            most = min(i, order - 1)
            k = next((k for k in range(most, 0, -1) if counts[tuple(d[i - k:i + 1])] >= min_count), 0)
            p = counts[tuple(d[i - k:i + 1])] / (counts[tuple(d[i - k:i])] if k else total)
            s += math.log(p) + (most - k) * math.log(backoff)
            given_up += k < most
        out.append((len(d), given_up, s / len(d) if d else None))
    return out


TEXTS = ODD_TEXTS + ["the cat sat on the mat", "The Cat sat on a mat", "a mat on the cat", "hot pair " * 500] + ["common line of words"] * 30


@pytest.mark.parametrize("order,block_words,part_ngrams,min_count", [
    (3, 1 << 21, 1 << 21, 1), (3, 40, 16, 1), (2, 40, 100, 1), (1, 100, 1000, 1), (4, 7, 64, 1), (3, 40, 1000, 2), (4, 100, 64, 3)])
def test_scores_match_brute_force(spark, order, block_words, part_ngrams, min_count):
    docs = documents(spark, TEXTS).repartition(3).select("*", F.lit(1).alias("block"), F.lit(2).alias("TEXT"))
    found = stupid_backoff(docs, order=order, block_words=block_words, part_ngrams=part_ngrams, min_count=min_count)
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == len(TEXTS)
    for i, (n, given_up, mean) in enumerate(brute_scores(TEXTS, order, min_count=min_count)):
        assert (got[i].n_words, got[i].n_backed_off) == (n, given_up)
        assert got[i].log_score is None if mean is None else math.isclose(got[i].log_score, mean, abs_tol=2e-6)


def test_ngram_rows_cross_one_exchange(spark):
    from helpers import plan_text
    placed = blocks(documents(spark, TEXTS).select("doc_id", "text"), 40)
    shared = counts_elsewhere(ngram_rows(placed, 3), 8)
    shared.collect()  # adaptive execution finds the equal exchange as it goes
    plan = plan_text(shared)
    assert "ReusedExchange" in plan and "ShuffledHashJoin" in plan


def test_scores_of_empty_repeated_and_null_rows(spark):
    assert stupid_backoff(documents(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = stupid_backoff(rows).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got) == [(0, 0), (1, 2), (1, 2)]
    only_empty = stupid_backoff(documents(spark, ["", None, " "])).collect()
    assert [(r.n_words, r.log_score) for r in only_empty] == [(0, None)] * 3


@pytest.mark.parametrize("exchange,order,block_words,part_ngrams,row_ngrams", [
    ("rows", 3, 40, 16, 1), ("arrays", 3, 40, 16, 1), ("arrays", 4, 7, 64, 2), ("arrays", 2, 40, 1, 1)])
def test_both_exchanges_match_brute_force(spark, exchange, order, block_words, part_ngrams, row_ngrams):
    found = stupid_backoff(documents(spark, TEXTS).repartition(3), order=order, block_words=block_words, part_ngrams=part_ngrams,
                           exchange=exchange, row_ngrams=row_ngrams)
    got = {r.doc_id: r for r in found.collect()}
    for i, (n, given_up, mean) in enumerate(brute_scores(TEXTS, order)):
        assert (got[i].n_words, got[i].n_backed_off) == (n, given_up)
        assert got[i].log_score is None if mean is None else math.isclose(got[i].log_score, mean, abs_tol=2e-6)


def test_ngrams_cross_the_shuffle_in_few_rows_and_bytes(spark):
    """Distinct n-grams of one block take under 7 bytes each, in rows that stay long as the corpus grows."""
    from netpulse.llm.lm import arrays_elsewhere, hash_ranges, ngram_arrays
    rnd = random.Random(1)
    texts = [" ".join(str(rnd.randrange(10**9)) for _ in range(1000)) for _ in range(40)]
    placed = blocks(documents(spark, texts).select("doc_id", "text").coalesce(1)).cache()
    n = 3 * 40_000 - 3 * 40  # no n-gram twice
    arrays = ngram_arrays(placed, 3, 3)
    rows = arrays.collect()
    assert sorted((r.n, r.range) for r in rows) == [(i, j) for i in (1, 2, 3) for j in range(8)]
    assert sum(len(r.hashes) + len(r.own) for r in rows) < 7 * n
    assert sum(len(r.others) for r in arrays_elsewhere(arrays).collect()) < n // 20  # nothing is shared
    placed.unpersist()
    bits = [hash_ranges(c, 1 << 21, 1 << 21, 256, 16) for c in (10**6, 10**9, 10**13, 10**15)]
    assert bits == [4, 9, 13, 13]  # 2 ** 13 ranges leave a full block 256 words a row


def test_longer_ngrams_travel_only_where_their_parts_are_shared(spark):
    from netpulse.llm.lm import arrays_elsewhere, longer_arrays, ngram_arrays
    placed = blocks(documents(spark, ["a b c d e", "a b c x y"]).select("doc_id", "text").coalesce(1), 5).cache()
    assert placed.count() == 2
    replies = arrays_elsewhere(ngram_arrays(placed, 2, 0))
    rows = longer_arrays(placed, replies, 3, 0).collect()
    # only "a b c" of both blocks: "c d", "c x" and what follows them are in one block alone
    assert [len(unpack(r.hashes, "uint64")) for r in rows] == [1, 1] and len({r.hashes for r in rows}) == 1
    placed.unpersist()


def test_answered_arrays_leave_no_shuffle_files(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    from netpulse.llm.common import FREE_SHUFFLES
    docs, before, setting = documents(spark, TEXTS).repartition(3), shuffles(), spark.conf.get(FREE_SHUFFLES)
    scores = stupid_backoff(docs, block_words=40, part_ngrams=16)
    # what is left are the dealt documents and the sum of the words: the n-gram arrays are gone
    assert len(shuffles() - before) <= 2
    assert spark.conf.get(FREE_SHUFFLES) == setting
    assert scores.count() == scores.count() == len(TEXTS)


def test_arrays_pack_and_unpack():
    import numpy as np
    a = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    assert (unpack(pack(a), np.uint64) == a).all()
    assert len(unpack(pack(a[:0]), np.uint64)) == 0
