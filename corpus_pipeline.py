"""The corpus pipeline: documents in, packed training sequences out.

Stages, each over all that its predecessor kept and written before the next one:
the quality classifier and the quality rules drop the documents they reject,
exact and near duplicates keep one document of each group, and the rest is packed.

Every stage reads whole texts of any length, takes a null text as an empty one, decides repeated
rows and rows with null ids one by one and turns an empty table into an empty one; all but the
last pass further columns on, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netpulse.llm.common import read_table, written
from netpulse.llm.exact_dedup import drop_exact_duplicates
from netpulse.llm.packing import pack_documents
from netpulse.llm.quality import drop_low_quality
from netpulse.llm.rules import drop_rejected
from netpulse.llm.simhash import drop_near_duplicates


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality, by text and site, is one half or more stay."""
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and lie near their language stay."""
    return drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id stays."""
    return drop_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's pieces with their places in sequences of at most 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules), ("exact_dedup", exact_dedup),
          ("simhash_dedup", simhash_dedup), ("packing", packing)]

#: Trained models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; between stages the documents are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
