"""Quality rules: counting rules, and the divergence of a text from its language.

Everything is column arithmetic on built-in functions.  One pass turns each text
into counts: words, symbols, repeated lines and windows, a histogram of character
classes and one of the common words of its language.  A language's reference is, bin by
bin, the median share over its different texts that pass the counting rules, in
permille: every text has one vote whatever its length and however often it is copied, so
what a language's texts are measured against moves only if half of them are junk.  A
language with too few such texts is measured against the medians over all languages.
A document whose Jensen-Shannon distance from the reference (the root of the divergence
in bits) exceeds a limit is rejected, provided it is long enough for its histogram to
mean something.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, pick, written

SPACE = "[\\x20\\x09-\\x0D]"
NO_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

#: The twenty or so commonest function words of each language (public word frequency lists).
COMMON_WORDS = {
    "en": "the of and to a in is at it that for on was with be as this by are from",
    "de": "der die und in den von zu das mit sich auf des für ist nicht im dem ein eine als",
    "fr": "de la le et les des un en du une que est pour qui dans sur au par pas avec",
    "es": "de la que el en y los se del las un por con para no su una al es lo",
}
N_COMMON = 20

#: Bins of the histograms ``classes`` and ``commons``: upper case, not ASCII, space, punctuation, symbol, other
#: characters; the common words by rank, other words.
N_BINS = {"classes": 6, "commons": N_COMMON + 1}

#: Limits of the distances, and the words a text needs for each to count.
MAX_CLASS_DISTANCE, MIN_CLASS_WORDS = 0.18, 30
MAX_WORD_DISTANCE, MIN_WORD_WORDS = 0.35, 100
#: A reference text has this many words; a language with fewer of them is measured against all languages.
REFERENCE_WORDS, REFERENCE_TEXTS = 50, 20


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the window hashes by position."""
    none = F.array().cast("array<bigint>")
    numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.size(hashes)

    def shifted(a: Column) -> Column:
        return F.slice(a, 2, F.size(a))

    # equal neighbours in hash order: both positions start a repeated window
    twice = F.filter(F.zip_with(F.slice(numbered, 1, n - 1), F.slice(numbered, 2, n), lambda a, b: F.when(
        a["h"] == b["h"], F.struct(a["i"].alias("i"), b["i"].alias("j")))), lambda x: x.isNotNull())
    at = F.sort_array(F.array_distinct(F.concat(F.transform(twice, lambda x: x["i"]), F.transform(twice, lambda x: x["j"]))))
    covered = F.aggregate(at, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")), lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(hashes)) == n, F.lit(0).cast("bigint")) \
        .when(hashes == none, F.lit(0).cast("bigint")).otherwise(covered)


def text_counts(docs: DataFrame) -> DataFrame:
    """The counts of every ``(doc_id, text, lang)``; each step is a projection of its own so that arrays are built once."""
    words = F.array_remove(F.split("text", SPACE + "+"), "")
    step = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang")) \
        .select("*", F.xxhash64("text").alias("text_key"), words.alias("words"))
    known = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
    plain = F.transform("words", lambda w: F.rtrim(F.lower(w), F.lit(".,")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NO_SPACE))
    step = step.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
                       F.filter(plain, lambda w: w.isin(known)).alias("common"), lines.alias("lines"))
    last = F.size("words") - WINDOW
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(
        *[F.col("hashes")[i + k] for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    ranked = reduce(lambda c, lang: c.when(F.col("lang") == lang, F.array(*map(F.lit, COMMON_WORDS[lang].split()))),
                    COMMON_WORDS, F.when(F.lit(False), F.array().cast("array<string>")))
    per_word = F.transform(ranked, lambda c: F.size(F.filter("common", lambda w: w == c)))
    step = step.select(
        "doc_id", "lang", "text_key", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"), F.coalesce(per_word, F.array_repeat(F.lit(0), N_COMMON)).alias("ranked"),
        F.array(*[F.regexp_count("text", F.lit(c)) for c in ("[A-Z]", "[^\\x00-\\x7F]", "[.,;:!?]")]).alias("marks"))
    step = step.select("*", _repeated_words(F.col("windows")).alias("n_repeat_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    classes = [F.col("marks")[0], F.col("marks")[1], F.col("n_chars") - F.col("word_chars"), F.col("marks")[2], F.col("n_symbols")]
    classes.append(F.col("n_chars") - reduce(lambda a, b: a + b, classes))
    others = F.col("n_words") - F.aggregate("ranked", F.lit(0).cast("long"), lambda a, x: a + x)
    return step.select("doc_id", "lang", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), F.array(*[c.cast("long") for c in classes]).alias("classes"),
                       F.concat(F.col("ranked").cast("array<bigint>"), F.array(others)).alias("commons"))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits) between two arrays of shares; 0 where one is missing."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.sqrt(F.greatest(total, F.lit(0.0)) / 2), F.lit(0.0))


def _medians(h: str) -> list[Column]:
    """The lower median of each bin of a histogram; the aggregate counts the permille values, 1,001 at most."""
    return [F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {h}[{i}])").cast("long") for i in range(N_BINS[h])]


def references(counts: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``(lang, ref_classes, ref_commons)``, shares per language, and the two arrays for a language without a reference.

    Of a text that several documents of a language share one counts.
    """
    sound = counts.where(~F.col("base_failed") & (F.col("n_words") >= REFERENCE_WORDS)).dropDuplicates(["lang", "text_key"])
    total = "aggregate({0}, 0L, (a, x) -> a + x)"
    permille = sound.select("lang", *[F.expr(f"transform({h}, x -> 1000 * x div {total.format(h)})").alias(h) for h in N_BINS])
    votes = written(permille, "votes")
    by_lang = votes.groupBy("lang").agg(*[F.array(*_medians(h)).alias(h) for h in N_BINS], F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= REFERENCE_TEXTS).select("lang", *[_shares(F.col(h)).alias("ref_" + h) for h in N_BINS])
    listed = F.col("lang").isin(list(COMMON_WORDS))
    whole = [votes.agg(F.array(*_medians("classes"))).first()[0], votes.where(listed).agg(F.array(*_medians("commons"))).first()[0]]
    return by_lang, [_shares(F.array(*[F.lit(x).cast("long") for x in m])) for m in whole]


def with_distances(counts: DataFrame, refs: DataFrame, whole: list[Column]) -> DataFrame:
    """The counts with both distances; the common words of a language without a list have none."""
    joined = counts.join(refs, "lang", "left")
    classes, commons = (F.coalesce(F.col("ref_" + h), w) for h, w in zip(N_BINS, whole, strict=True))
    return joined.select(
        *counts.columns, distance(_shares(F.col("classes")), classes).alias("class_distance"),
        F.when(F.col("lang").isin(list(COMMON_WORDS)), distance(_shares(F.col("commons")), commons)).otherwise(0.0).alias("word_distance"))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """One row per document: the counts, ``base_failed``, both distances and ``kept``.

    A null text has no words and fails the base rules, as an empty one does.  A null
    language is a language of its own.  A language without listed common words is judged
    by its character classes alone, one with too few reference texts against all
    languages; a table without any reference text is judged by the counting rules.
    Repeated rows give repeated results; an empty table gives an empty result.
    """
    counts = written(text_counts(pick(docs, doc_id=id_col, text=text_col, lang=lang_col)), "counts")
    judged = with_distances(counts, *references(counts))
    far = ((F.col("n_words") >= MIN_CLASS_WORDS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)) | \
        ((F.col("n_words") >= MIN_WORD_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns, also such as differ in case only.

    Null and empty texts have no words and go, very long ones are counted whole; repeated
    rows are decided one by one, null ids included; an empty table gives an empty one.
    """
    return keep_rows(docs, lambda rows, number: quality_rules(rows, id_col=number).where("kept").select("doc_id"))
