"""Registered queries of the text operators: each takes ``(spark, sf_dir)``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .bpe import encode_documents
from .common import pick, read_table
from .exact_dedup import exact_duplicates
from .line_dedup import dedup_lines
from .lm import stupid_backoff
from .packing import pack_documents
from .periodic import periodic_runs, plant_runs
from .quality import classify_quality
from .rules import quality_rules
from .search import ranked_search
from .simhash import near_duplicates
from .token_counts import count_tokens
from .url_filter import filter_urls, labelled_urls, train_url_model
from .warc import archive_round_trip


def op1_quality_classifier(spark, sf_dir):
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_lm_scoring(spark, sf_dir):
    return stupid_backoff(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(plant_runs(pick(read_table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")))
    # runs compare by length / period; the quotients of equal fractions are equal doubles
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length"))))
    listed = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def op12_ranked_search(spark, sf_dir):
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_line_dedup(spark, sf_dir):
    return dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_simhash_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_bpe_codec(spark, sf_dir):
    coded = encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_counts(spark, sf_dir):
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_rules(spark, sf_dir):
    return quality_rules(read_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_warc_archives(spark, sf_dir):
    return archive_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_url_filter(spark, sf_dir):
    model = train_url_model(labelled_urls(spark))
    return filter_urls(read_table(spark, sf_dir, "pages"), model).drop("model_blocks")


def op9_exact_dedup(spark, sf_dir):
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("op")}
