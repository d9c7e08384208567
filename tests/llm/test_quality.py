import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import ODD_TEXTS, WORD, documents, rule_counts
from pyspark.sql import functions as F

import corpus_pipeline
from netpulse.llm import common, quality, rules
from netpulse.llm.common import _is_file_scan, pick, read_table
from netpulse.llm.exact_dedup import drop_exact_duplicates
from netpulse.llm.quality import MAX_TRAINING_ROWS, classify_quality, drop_low_quality, fit_logistic
from netpulse.llm.rules import drop_rejected, quality_rules
from netpulse.llm.simhash import drop_near_duplicates

PROSE = "The house of the old man is in the north and it was built by his father for a family that lived there with him. "


def shares(counts):
    n = sum(counts)
    return [c / n for c in counts] if n else None


def jensen_shannon(p, q):
    def part(a, b):
        return a * math.log2(2 * a / (a + b)) if a else 0.0
    return sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2 if p and q else 0.0


def brute_rules(rows):
    """The verdicts of (text, lang) rows, computed one by one."""
    rows = [(t or "", g or "") for t, g in rows]
    counts = [rule_counts(t) for t, _ in rows]
    failed = [c[0] < 10 or 100 * c[4] > 20 * c[0] for c in counts]
    hist = []
    for (t, g), c in zip(rows, counts):
        cls = [len(re.findall("[A-Z]", t)), len(re.findall("[^\x00-\x7f]", t)), len(t) - c[1], len(re.findall("[.,;:!?]", t)), c[2]]
        plain = Counter(w.lower().rstrip(".,") for w in WORD.findall(t))
        com = [plain[w] for w in rules.COMMON_WORDS[g].split()] if g in rules.COMMON_WORDS else [0] * rules.N_COMMON
        hist.append((cls + [len(t) - sum(cls)], com + [c[0] - sum(com)]))

    def medians(members, k):
        if not members:
            return None
        permille = sorted({rows[j]: [1000 * v // sum(hist[j][k]) for v in hist[j][k]] for j in members}.values())
        return shares([sorted(column)[(len(permille) - 1) // 2] for column in zip(*permille)])

    sound = [i for i, c in enumerate(counts) if not failed[i] and c[0] >= rules.REFERENCE_WORDS]
    whole = [medians(sound, 0), medians([i for i in sound if rows[i][1] in rules.COMMON_WORDS], 1)]
    refs = {}
    for g in {g for _, g in rows}:
        of = [i for i in sound if rows[i][1] == g]
        enough = len({rows[i] for i in of}) >= rules.REFERENCE_TEXTS
        refs[g] = [medians(of, k) if enough else whole[k] for k in (0, 1)]
        if g not in rules.COMMON_WORDS:
            refs[g][1] = None
    d = [[math.sqrt(max(jensen_shannon(shares(hist[i][k]), refs[g][k]), 0)) if refs[g][k] and sum(hist[i][k]) else 0.0 for k in (0, 1)]
         for i, (_, g) in enumerate(rows)]
    kept = [not f and not (c[0] >= rules.MIN_CLASS_WORDS and x > rules.MAX_CLASS_DISTANCE)
            and not (c[0] >= rules.MIN_WORD_WORDS and w > rules.MAX_WORD_DISTANCE) for f, c, (x, w) in zip(failed, counts, d)]
    return counts, failed, kept


def test_rules_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = PROSE.split()
    texts, langs = list(ODD_TEXTS), ["en"] * len(ODD_TEXTS)
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        if i % 10 == 0:
            words = [w.upper() + "!!" for w in words]
        if i % 10 == 1:
            words = [w + rng.choice(["%%%", "$$$"]) for w in words]
        if i % 10 == 2:
            words = words[:7] * 9 + words
        texts.append(" ".join(words) + ("\nsame line\nsame line " if i % 7 == 0 else ""))
        langs.append(rng.choice(["en", "en", "en", "fr", "xx", None]))
    docs = documents(spark, texts, langs).select("*", F.lit(1).alias("words"), F.lit(2).alias("kept"), F.lit(3).alias("LANG"))
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    counts, failed, kept = brute_rules(list(zip(texts, langs)))
    for i in range(len(texts)):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts[i]
        assert r.base_failed == failed[i]
        assert r.kept == kept[i]
    assert 0 < sum(kept) < sum(not f for f in failed)


def _texts(n, seed, words=160):
    rng = random.Random(seed)
    return [" ".join(rng.choice(PROSE.split()) for _ in range(words)) for _ in range(n)]


def _junk(n, words=160, seed=9):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["%%", "##", "1234", "<x>", "$9|", "&&&"]) for _ in range(words)) + f" {i}" for i in range(n)]


def _kept(spark, texts, langs):
    kept = quality_rules(documents(spark, texts, langs)).collect()
    assert [r.kept for r in sorted(kept, key=lambda r: r.doc_id)] == brute_rules(list(zip(texts, langs)))[2]
    return {r.doc_id for r in kept if r.kept}


def test_a_junk_source_of_a_third_sets_no_reference(spark):
    sound, junk = _texts(60, 1), _junk(30)
    # and copies of junk, which have one vote together
    texts = sound + junk + junk[:1] * 80
    assert _kept(spark, texts, ["en"] * len(texts)) == set(range(60))


def test_a_rare_language_is_measured_against_all(spark):
    texts = _texts(40, 2) + _junk(3) + _texts(3, 3)
    langs = ["en"] * 40 + ["xx"] * 3 + ["yy"] * 3
    assert _kept(spark, texts, langs) == set(range(40)) | {43, 44, 45}
    texts = _texts(40, 2) + _junk(3, seed=8)
    assert _kept(spark, texts, ["en"] * 40 + ["de"] * 3) == set(range(40))


def test_rules_stay_on_the_jvm(spark):
    from helpers import plan_text
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    counts = rules.text_counts(pick(docs, doc_id="doc_id", text="text", lang="lang"))
    assert "Python" not in plan_text(counts) and "Arrow" not in plan_text(counts)
    judged = plan_text(quality_rules(docs))
    assert "Python" not in judged and "Arrow" not in judged


def test_rules_empty_table_and_filter(spark):
    docs = documents(spark, [PROSE * 2, "short", None])
    assert quality_rules(docs.limit(0)).count() == 0
    kept = drop_rejected(documents(spark, [" ".join(random.Random(i).sample(PROSE.split(), 20)) for i in range(8)] + ["short", None]))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(8))


@pytest.mark.parametrize("reps", [1, 2, 3])
def test_repeated_windows_overlap(spark, reps):
    text = " ".join((["a"] * 6 + ["b", "c", "d", "e", "f"] * reps + ["x y z"] + ["a"] * 5))
    r = quality_rules(documents(spark, [text])).first()
    assert r.n_repeat_words == rule_counts(text)[4]


def test_statistics_of_odd_texts():
    for t in ODD_TEXTS:
        x = quality.text_statistics((t or "").encode())
        assert len(x) == len(quality.FEATURES) and np.isfinite(x).all()


def test_logistic_fit_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    w = fit_logistic(x, y)
    assert (((x @ w[:-1] + w[-1]) > 0) == (y > 0)).mean() > 0.98
    assert (fit_logistic(x[:0], y[:0]) == 0).all()
    assert np.isfinite(fit_logistic(x, np.ones(400))).all()


def brute_posteriors(evidence):
    """Posteriors of (host, path, p) rows by the documented formulas, in plain loops."""
    paths, hosts = defaultdict(list), defaultdict(list)
    for h, s, p in evidence:
        paths[h, s].append(p)
        hosts[h].append(p)
    n, mean = len(evidence), sum(p for *_, p in evidence) / len(evidence)

    def strength(groups, centre):
        spread = sum(len(g) * (sum(g) / len(g) - centre(k)) ** 2 for k, g in groups.items())
        scatter = sum(max(sum(x * x for x in g) - sum(g) ** 2 / len(g), 0) / len(g) for g in groups.values())
        v = max((spread - scatter) / n, 1e-9)
        c = sum(centre(k) * (1 - centre(k)) * len(g) for k, g in groups.items()) / n
        return min(max(c / v - 1, quality.STRENGTHS[0]), quality.STRENGTHS[1])

    ks = strength(hosts, lambda k: mean)
    prior = lambda h: (sum(hosts[h]) + ks * mean) / (len(hosts[h]) + ks)
    kp = strength(paths, lambda k: prior(k[0]))
    out = []
    logit = lambda x: math.log(x / (1 - x))
    for h, s, p in evidence:
        up = (sum(hosts[h]) - p + ks * mean) / (len(hosts[h]) - 1 + ks)
        site = (sum(paths[h, s]) - p + kp * up) / (len(paths[h, s]) - 1 + kp)
        out.append((site, 1 / (1 + math.exp(-(logit(p) + logit(min(max(site, 1e-4), 1 - 1e-4)) - logit(mean))))))
    return out


def test_posteriors_match_brute_force(spark, tmp_path):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    # half of one host is junk, so sites matter
    docs = docs.withColumn("text", F.when((F.col("source") == "src0") & (F.col("doc_id") % 2 == 0), F.lit("BUY!! NOW!! BUY!! NOW!!"))
                           .otherwise(F.col("text"))).select("*", F.lit("x").alias("host"), F.lit("y").alias("TEXT"), F.lit(1).alias("Source"))
    labels = read_table(spark, "/root/testdata/sf0.001", "labels")
    got = classify_quality(docs, labels).collect()
    assert len(got) == docs.count()
    want = brute_posteriors([(r.host, r.path, r.evidence) for r in got])
    for r, (site, posterior) in zip(got, want):
        assert math.isclose(r.site, site, rel_tol=1e-9) and math.isclose(r.posterior, posterior, rel_tol=1e-6)
        assert r.kept == (r.posterior >= 0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = classify_quality(docs, train).join(test, "doc_id").select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in got) / len(got) > 0.97
    assert sum(r.kept for r in got if r.quality == 1) / sum(r.quality for r in got) > 0.98


def test_classifier_edge_rows(spark):
    docs = documents(spark, ["some text here", None, "", "more text"], sources=["a/b", None, "a", "a/b/c"])
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (1, None), (99, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in classify_quality(docs, labels).collect()}
    assert len(got) == 4 and (got[0].host, got[0].path) == ("a", "/en/b") and got[1].host == ""
    none = classify_quality(docs, labels.limit(0)).collect()
    assert all(r.kept and abs(r.evidence - 0.5) < 1e-9 for r in none)
    assert classify_quality(docs.limit(0), labels).count() == 0
    repeated = docs.unionByName(docs)
    assert classify_quality(repeated, labels).count() == 8


def test_training_rows_are_bounded(spark):
    docs = documents(spark, [f"text {i}" for i in range(30)])
    stats = quality.statistics(pick(docs.withColumn("h", F.lit("")), doc_id="doc_id", host="h", path="h", text="text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("good"))
    assert MAX_TRAINING_ROWS == 20_000
    assert (quality.train_evidence(stats, labels, 5) != quality.train_evidence(stats, labels, 30)).any()


def test_pipeline_stages_equal_their_operators(spark):
    """Each stage, on what its predecessor kept, against that operator's own verdicts."""
    sf = "/root/testdata/sf0.001"
    docs = read_table(spark, sf, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "exact_dedup", "simhash_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        after = docs.collect()
        assert all(before[r.doc_id] == r for r in after) and len({r.doc_id for r in after}) == len(after)
        ids = [r.doc_id for r in after]
        if name == "quality_rules":
            order = sorted(before)
            kept = brute_rules([(before[i].text, before[i].lang) for i in order])[2]
            assert sorted(ids) == [i for i, k in zip(order, kept) if k]
        if name == "exact_dedup":
            last = {}
            for i in sorted(before):
                last[before[i].text.lower() if before[i].text.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), before[i].text)] = i
            assert sorted(ids) == sorted(last.values())
        if name == "simhash_dedup":
            from helpers_llm import near_classes, simhash
            order = sorted(before)
            assert sorted(ids) == sorted({order[c] for c in near_classes([simhash(before[i].text) for i in order])})
        docs = spark.createDataFrame(after, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole)
    assert {r.doc_id for r in whole} == set(ids)


def test_low_quality_filter_keeps_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = read_table(spark, sf, "documents")
    kept = drop_low_quality(docs, read_table(spark, sf, "labels"))
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_pipeline_decides_repeated_rows_and_null_ids_one_by_one(spark, tmp_path):
    """A third of the rows without an id, and rows that come three times: every stage keeps just the rows it decided on."""
    sf = "/root/testdata/sf0.001"
    docs = read_table(spark, sf, "documents")
    again = docs.where("doc_id % 5 = 1")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id"))).unionByName(again).unionByName(again)
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    def through(name, docs):
        out = stages[name](spark, docs, sf)
        assert out.columns == columns
        rows = out.collect()
        assert not Counter(map(tuple, rows)) - Counter(map(tuple, docs.collect()))
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}"), rows

    verdicts = classify_quality(docs, read_table(spark, sf, "labels"))
    judged = Counter((r.doc_id, r.host) for r in verdicts.where("kept").collect())
    docs, rows = through("quality_classifier", docs)
    assert Counter((r.doc_id, r.source.split("/")[0]) for r in rows) == judged
    kept = brute_rules([(r.text, r.lang) for r in rows])[2]
    want = Counter(r.text for r, k in zip(rows, kept) if k)
    docs, rows = through("quality_rules", docs)
    assert Counter(r.text for r in rows) == want
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    best = {}
    for r in rows:
        best[lower(r.text)] = max(best.get(lower(r.text), -1), -1 if r.doc_id is None else r.doc_id)
    docs, rows = through("exact_dedup", docs)
    assert sorted((lower(r.text), -1 if r.doc_id is None else r.doc_id) for r in rows) == sorted(best.items())
    from helpers_llm import near_classes, simhash
    least = {}
    for r, c in zip(rows, near_classes([simhash(r.text) for r in rows])):
        least[c] = min(least.get(c, math.inf), math.inf if r.doc_id is None else r.doc_id)
    docs, rows = through("simhash_dedup", docs)
    assert sorted(math.inf if r.doc_id is None else r.doc_id for r in rows) == sorted(least.values())
    packed = stages["packing"](spark, docs, sf).where("piece = 0")
    assert packed.count() == len(rows)


@pytest.mark.parametrize("stored", [False, True])
def test_filters_of_rows_without_any_id(spark, tmp_path, stored):
    texts = ["Same Text"] * 3 + ["same text", "another one"]
    docs = documents(spark, texts).withColumn("doc_id", F.lit(None).cast("long")).withColumn("__row", F.lit(7))
    if stored:  # a bare table is not copied: its rows are told apart by their place
        docs.repartition(3).write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
        assert _is_file_scan(docs)
    for drop in (drop_exact_duplicates, drop_near_duplicates):
        got = drop(docs)
        assert got.columns == docs.columns
        assert sorted(r.text.lower() for r in got.collect()) == ["another one", "same text"]


@pytest.mark.parametrize("marks", [0, 1 << 14])
def test_verdicts_reach_their_rows_by_bitmaps(spark, tmp_path, monkeypatch, marks):
    """Several files, a file of more rows than a bitmap holds, and files of which no row or every row stays."""
    monkeypatch.setattr(common, "BROADCAST_MARKS", marks)
    n, path = 2 * common.MARK_ROWS + 777, str(tmp_path / "docs")
    for part, (lo, size) in enumerate([(0, n), (n, 50), (n + 50, 60), (n + 110, 1)]):
        spark.range(lo, lo + size, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")) \
            .write.mode("append" if part else "overwrite").parquet(path)
    docs = spark.read.parquet(path)
    stays = F.expr(f"doc_id < {n} AND doc_id % 3 = 0 OR doc_id IN (7, 32766, 32767, 32768, {n - 2}) OR doc_id BETWEEN {n + 50} AND {n + 109}")
    width = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = common.keep_rows(docs, lambda rows, key: rows.where(stays).select(key))
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", width)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.where(stays).collect()))
    assert ("Exchange hashpartitioning" in plan) == (marks == 0), plan
    assert common.keep_rows(docs, lambda rows, key: rows.limit(0).select(key)).count() == 0


def test_pipeline_of_an_empty_table_and_of_very_long_texts(spark, tmp_path):
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    plain = "the people of the town went to the market and some of them came back with bread for their children today "
    draw, made = random.Random(5), [a + b + c for a in ("mar", "ton", "sel", "ri", "ve", "la") for b in ("ka", "ne", "do", "sti", "pur") for c in ("te", "n", "rs", "")]
    texts = [None, "", plain, " ".join(draw.choice(plain.split() if draw.random() < 0.5 else made) for _ in range(200_000))]
    for name, docs in (("none", documents(spark, [None]).limit(0)), ("long", documents(spark, texts))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.limit(0).write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    rows = corpus_pipeline.run(spark, f"{tmp_path}/long").collect()
    ids = {r.doc_id for r in rows}
    assert ids == {2, 3}, ids
    spans = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:]) if a[0] == b[0])
