import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import ODD_TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from netpulse.llm import bpe, token_counts
from netpulse.llm.bpe import ByteBpe, encode_documents, tokenizer_file
from netpulse.llm.packing import best_fit_plan, encoder, pack_documents
from netpulse.llm.queries import op3_bpe_codec
from netpulse.llm.token_counts import WordBpe, count_tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BYTE_LIB, WORD_LIB = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
BYTE_OWN, WORD_OWN = ByteBpe(tokenizer_file(BYTE)), WordBpe(tokenizer_file(WORD))
TEXT = st.text(st.one_of(st.sampled_from(" \n\t'.,aethsndr<|>ÉßΣ中5\x1c\xa0"), st.characters(codec="utf-8")), max_size=60)


def ids_of(text):
    return BYTE_LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_encoder_equals_the_library(texts):
    for t, ids in zip(texts, BYTE_OWN.encode(texts)):
        want = ids_of(t)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert BYTE_OWN.decode(ids) == BYTE_LIB.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_counter_equals_the_library(texts):
    assert WORD_OWN.count(texts) == [len(WORD_LIB.encode(t, add_special_tokens=False).ids) for t in texts]


def test_every_code_point_equals_the_library():
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    texts = ["".join(f"x{chr(c)}W 1{chr(c)}2 {chr(c)}'s" for c in points[lo:lo + 4000]) for lo in range(0, len(points), 4000)]
    for lo in range(0, len(texts), 40):
        part = texts[lo:lo + 40]
        want = BYTE_LIB.encode_batch(part, add_special_tokens=False)
        assert all(np.frombuffer(ids, "<u4").tolist() == w.ids for ids, w in zip(BYTE_OWN.encode(part), want))
        assert WORD_OWN.count(part) == [len(w.ids) for w in WORD_LIB.encode_batch(part, add_special_tokens=False)]


def test_characters_that_unicode_versions_see_differently():
    texts = ["\ua7dcW", "\ua7cb", "\U00018f08\u8067", "a\U0003d000b 1\U000191bf2", "\U0003d000"]
    assert WORD_OWN.count(texts) == [len(WORD_LIB.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in BYTE_OWN.encode(texts)] == [ids_of(t) for t in texts]


def test_an_unbroken_run_of_a_million_letters():
    text = "".join(random.Random(4).choices("etaoinshrdlu", k=1 << 20))
    began = time.monotonic()
    assert WORD_OWN.count([text, "b" + text[:5000]]) == [len(e.ids) for e in WORD_LIB.encode_batch([text, "b" + text[:5000]])]
    assert np.frombuffer(BYTE_OWN.encode([text])[0], "<u4").tolist() == ids_of(text)
    assert time.monotonic() - began < 60


def test_caches_are_bounded_in_characters(monkeypatch):
    own, codec = WordBpe(tokenizer_file(WORD)), ByteBpe(tokenizer_file(BYTE))
    monkeypatch.setattr(token_counts, "CACHE_CHARS", 100)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 100)
    for i in range(20):
        t = f"{'abc' * 20}{i} word"
        assert own.count([t]) == [len(WORD_LIB.encode(t).ids)]
        assert np.frombuffer(codec.encode([t])[0], "<u4").tolist() == ids_of(t)
        assert own._held < 300 and codec._held < 300


def test_compiled_encoder_of_packing_equals_the_library():
    e = encoder(tokenizer_file(BYTE))
    for t in ODD_TEXTS:
        assert e.encode_to_numpy(t or "", allowed_special="all").tolist() == ids_of(t)


def test_full_caches_start_anew(monkeypatch):
    own = WordBpe(tokenizer_file(WORD))
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    for t in ("alpha beta gamma delta", "beta epsilon zeta eta", "alpha"):
        assert own.count([t]) == [len(WORD_LIB.encode(t).ids)]


def test_codec_over_documents(spark):
    docs = documents(spark, ODD_TEXTS).select("*", F.lit("clash").alias("ids"), F.lit(1).alias("DOC_ID"))
    got = {r.doc_id: r for r in encode_documents(docs, BYTE).collect()}
    for i, t in enumerate(ODD_TEXTS):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids_of(t)
        assert got[i].decoded == (t or "")
    assert encode_documents(docs.limit(0), BYTE).count() == 0


def test_codec_query_digests(spark, tmp_path):
    documents(spark, ODD_TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op3_bpe_codec(spark, str(tmp_path)).collect()}
    for i, t in enumerate(ODD_TEXTS):
        ids = ids_of(t)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_counts_over_documents(spark):
    docs = documents(spark, ODD_TEXTS + ["repeated row"] * 2).withColumn("n_tokens", F.lit("clash"))
    got = {r.doc_id: r for r in count_tokens(docs, WORD, limit=100).collect()}
    for i, t in enumerate(ODD_TEXTS):
        n = len(WORD_LIB.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)
    assert count_tokens(docs.limit(0), WORD).count() == 0


def brute_best_fit(lengths, capacity):
    """Sequences used by best-fit decreasing, one piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    return len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_one_by_one_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 400))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    filled, ranks = defaultdict(list), defaultdict(list)
    for s in best_fit_plan(histogram, capacity):
        ranks[s.length] += range(s.first_rank, s.first_rank + s.sequences * s.each)
        for q in range(s.sequences):
            filled[s.first_sequence + q] += [(s.offset + i * s.length, s.length) for i in range(s.each)]
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(filled) == brute_best_fit(lengths, capacity)


def test_packing_over_documents(spark):
    texts = ODD_TEXTS + ["the same short text"] * 60 + ["many words " * 40] * 9
    docs = documents(spark, texts).withColumn("rank", F.lit("clash")).withColumn("length", F.lit(0))
    capacity = 256
    rows = pack_documents(docs, BYTE, capacity, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, t in enumerate(texts):
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == ids_of(t) + [0]
        assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        assert all(r.length == capacity for r in parts[1:])
    for parts in by_sequence.values():
        ends = [0]
        for offset, n in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + n)
        assert ends[-1] <= capacity
    assert len(by_sequence) == brute_best_fit([r.length for r in rows], capacity)
    assert pack_documents(docs.limit(0), BYTE).count() == 0


def test_packing_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, None)], "doc_id long, text string")
    rows = pack_documents(docs, BYTE, 4).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (1, 3), (1, 3)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


@pytest.mark.parametrize("space", [" ", "\n", " \n\t"])
def test_packing_of_very_long_white_space(spark, space):
    run = space * (1_200_000 // len(space))
    texts = [run, "a" + run + "b c", run + "<|endoftext|>" + run + ".", "plain"]
    rows = pack_documents(documents(spark, texts), BYTE, with_ids=True).collect()
    for i, t in enumerate(texts):
        parts = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == ids_of(t) + [0]
