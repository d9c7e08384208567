"""Quality classifier: document evidence and site posteriors by hierarchical empirical Bayes.

A logistic regression on a few text statistics, fitted on a bounded sample of the
labelled documents, gives each document its own evidence.  Grouped aggregation sums
that evidence per path and per host; a host is shrunk towards the global mean and a
path towards its host, by strengths estimated from the spread of the groups (method
of moments), so a sparse site says little and a large one much.  A document's
posterior joins its evidence with what the *other* documents of its site say.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_rows, pick, text_bytes, written

#: At most so many labelled documents fit the evidence model (those with the smallest id hashes).
MAX_TRAINING_ROWS = 20_000
#: Evidence is held within these limits, so one document cannot outweigh a site.
LEAST_EVIDENCE = 1e-4
#: Bounds of the estimated prior strengths, in documents.
STRENGTHS = (2.0, 1e6)
MIN_POSTERIOR = 0.5

FEATURES = ["log_words", "word_variety", "repeats_next", "symbols", "marks", "shouting", "digits", "word_length",
            "plain_words", "repeated_lines"]
LETTERS = b"abcdefghijklmnopqrstuvwxyz"
SYMBOLS = b"#*$%&|<>@^~=+_/\\{}[]"
MARKS = b".,;:!?'\"()-"


def text_statistics(text: bytes) -> list[float]:
    """The statistics named in ``FEATURES``; all zero without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))
    upper = len(text) - len(text.translate(None, LETTERS.upper()))
    lines = [x for x in text.split(b"\n") if x.strip()]

    def share(characters: bytes) -> float:
        return (len(text) - len(text.translate(None, characters))) / size

    plain = sum(map(bytes.isalpha, [w.strip(MARKS) for w in words])) if text.isascii() else \
        sum(w.strip(MARKS).translate(None, SYMBOLS) == w.strip(MARKS) != b"" for w in words)
    return [float(np.log(n)), len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n, share(SYMBOLS), share(MARKS),
            upper / size, share(b"0123456789"), size / n, plain / n, 1 - len(set(lines)) / len(lines)]


def statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, host, path, x)``: the statistics of every ``(doc_id, text, host, path)``; further columns go along."""
    carried = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*[docs.schema[c] for c in carried], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([text_statistics(t) for t in text_bytes(b.column(len(carried)))], np.float64).reshape(-1, len(FEATURES))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))],
                                             names=schema.fieldNames())

    return docs.select(*carried, "text").mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression on standardised statistics by Newton steps; weights for raw statistics, bias last.

    Without both labels the model only knows the share of good documents.
    """
    if not len(y):
        return np.zeros(x.shape[1] + 1)
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    raw = w[:-1] / scale
    return np.append(raw, w[-1] - raw @ mean)


def train_evidence(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """Fit the evidence model on at most ``max_rows`` labelled documents; only those reach the driver."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("good").isNotNull()) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(max_rows)
    # the sample is bounded by max_rows, so it may be broadcast whatever the table's size
    rows = stats.join(F.broadcast(chosen), "doc_id").select("x", "good").limit(max_rows).collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    return fit_logistic(x, np.array([float(r["good"]) for r in rows]))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, mean: Column) -> Column:
    """Prior strength of groups ``(n, s, q)`` around ``mean``, by the method of moments.

    The spread of the group means beyond what their own scatter explains is taken as
    the prior's variance ``v``; a beta prior of that variance weighs ``mean (1 - mean) / v - 1``.
    """
    spread = F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2))
    scatter = F.sum(F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0)) / F.col("n"))
    variance = F.greatest((spread - scatter) / F.sum("n"), F.lit(1e-9))
    centre = F.sum(mean * (1 - mean) * F.col("n")) / F.sum("n")
    return F.least(F.greatest(centre / variance - 1, F.lit(STRENGTHS[0])), F.lit(STRENGTHS[1]))


def site_totals(evidence: DataFrame) -> DataFrame:
    """Sums of every path and its host, ``(host, path, n, s, host_n, host_s)``, with the estimated prior columns."""
    paths = written(evidence.groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in "nsq"])
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    host_strength = hosts.agg(_strength(hosts, F.lit(mean))).first()[0] or STRENGTHS[0]
    both = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    prior = (F.col("host_s") + host_strength * mean) / (F.col("host_n") + host_strength)
    path_strength = both.agg(_strength(both, prior)).first()[0] or STRENGTHS[0]
    return both.drop("q").withColumns({"mean": F.lit(float(mean)), "host_strength": F.lit(float(host_strength)),
                                       "path_strength": F.lit(float(path_strength))})


def document_site(source: Column, lang: Column) -> tuple[Column, Column]:
    """Host and path of ``documents``: the source up to its first ``/``, and what follows with the language."""
    return F.substring_index(source, "/", 1), F.concat(
        F.lit("/"), F.coalesce(lang, F.lit("")), F.regexp_extract(F.coalesce(source, F.lit("")), "/.*", 0))


def classify_quality(docs: DataFrame, labels: DataFrame, site_cols: tuple[str, ...] = ("source", "lang"),
                     site_of: Callable[..., tuple[Column, Column]] = document_site, text_col: str = "text",
                     id_col: str = "doc_id", label_col: str = "quality",
                     max_training_rows: int = MAX_TRAINING_ROWS, row_col: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, host, path, evidence, site, posterior, kept``.

    ``site_of`` turns the columns named by ``site_cols`` into host and path; a null
    counts as a site of its own.  ``site`` is the expected quality of the document's path
    from the other documents there; alone on its host it is the global mean.
    A document is kept from a posterior of one half.  A null or empty text is judged
    by statistics of zero.  Labels without a document, or null, are left out; without
    any label every document's evidence is one half.  Repeated rows each count and
    get equal results; an empty table gives an empty result.  The column ``row_col``,
    if named, goes along as ``row``.
    """
    row = {"row": row_col} if row_col else {}
    named = {f"site_{i}": c for i, c in enumerate(site_cols)}
    host, path = site_of(*[F.col(c) for c in named])
    source = pick(docs, doc_id=id_col, text=text_col, **named, **row).select(
        "doc_id", *row, "text", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    stats = written(statistics(source), "statistics")
    weights = train_evidence(stats, pick(labels, doc_id=id_col, good=label_col), max_training_rows)
    score = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        score = score + F.col("x")[i] * float(w)
    p = F.least(F.greatest(1 / (1 + F.exp(-score)), F.lit(LEAST_EVIDENCE)), F.lit(1 - LEAST_EVIDENCE))
    evidence = stats.select("doc_id", *row, "host", "path", p.alias("p"))
    sites = written(site_totals(evidence), "sites")
    # what the others of the site say: the document's own evidence is taken out
    host_prior = (F.col("host_s") - F.col("p") + F.col("host_strength") * F.col("mean")) / \
        (F.col("host_n") - 1 + F.col("host_strength"))
    site = (F.col("s") - F.col("p") + F.col("path_strength") * host_prior) / (F.col("n") - 1 + F.col("path_strength"))
    bounded = F.least(F.greatest(site, F.lit(LEAST_EVIDENCE)), F.lit(1 - LEAST_EVIDENCE))
    base = F.least(F.greatest(F.col("mean"), F.lit(LEAST_EVIDENCE)), F.lit(1 - LEAST_EVIDENCE))
    posterior = 1 / (1 + F.exp(-(logit(F.col("p")) + logit(bounded) - logit(base))))
    return evidence.join(sites, ["host", "path"]).select(
        "doc_id", *row, "host", "path", F.col("p").alias("evidence"), site.alias("site"), posterior.alias("posterior"),
        (posterior >= MIN_POSTERIOR).alias("kept"))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns, also such as differ in case only.

    Null and empty texts are judged by statistics of zero, very long ones whole; repeated
    rows are decided one by one, null ids included; an empty table gives an empty one.
    """
    return keep_rows(docs, lambda rows, number: classify_quality(rows, labels, row_col=number).where("kept").select("row"))
