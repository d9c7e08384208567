"""Line de-duplication: boilerplate lines that many documents share.

Columns only, no Python on the executors.  A line's key is the line stripped of white
space and lower-cased (A-Z).  Every key long enough becomes a row of its digest, its
document and its position.  The rows are dealt by range of (digest, salt) and sorted
inside by document, largest first, then position, so each segment of a digest streams
past in order and names its first occurrences: the first row of each of its first
documents.  A segment sends at most ``min_docs`` of them on, whatever its length; a
digest that a third of all documents share has ``SALTS`` segments in as many places.

The decision returns to the documents not as text but as a compressed bitmap: the runs
of lines that stay, one row per document that loses a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, pick, written

#: Keys of at least this many code points, found in at least this many documents, are boilerplate.
MIN_CHARS, MIN_DOCS = 20, 3
#: Segments of one digest: rows of a digest are dealt to this many keys of the range partitioning.
SALTS = 256
#: What is stripped at both ends of a line: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(digest, salt, doc_id, text_key, n_lines, pos)`` of every line of ``(doc_id, text)`` with a key long enough.

    ``text_key`` tells rows of one ``doc_id`` with different texts apart.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_key"), _lines(F.col("text")).alias("lines")) \
        .select("doc_id", "text_key", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line")) \
        .where(F.octet_length("line") >= min_chars)
    key = ascii_lower(F.btrim("line", F.lit(WHITE)))
    return lines.select("doc_id", "text_key", "n_lines", "pos", key.alias("key")) \
        .where(F.char_length("key") >= min_chars) \
        .select(F.unhex(F.md5("key")).alias("digest"),
                F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int").alias("salt"),
                "doc_id", "text_key", "n_lines", "pos")


def first_occurrences(rows: DataFrame, n: int) -> DataFrame:
    """``(digest, salt, doc_id)``: the ``n`` largest documents of each segment, a row each.

    Dealt by range of (digest, salt) and sorted by document and position inside; the
    running window reads a segment once and holds one row of it.
    """
    segment = Window.partitionBy("digest", "salt").orderBy(F.col("doc_id").desc_nulls_last(), "text_key", "pos")
    new = (F.row_number().over(segment) == 1) | ~F.lag("doc_id").over(segment).eqNullSafe(F.col("doc_id"))
    seen = F.sum(new.cast("int")).over(segment.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.select("digest", "salt", "doc_id", "text_key", "pos").repartitionByRange("digest", "salt") \
        .select("digest", "salt", "doc_id", new.alias("new"), seen.alias("seen")) \
        .where(F.col("new") & (F.col("seen") <= n)).select("digest", "salt", "doc_id")


def line_bitmaps(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, text_key, n_dropped, keep)`` of each document that loses a line; the others keep every line.

    ``keep`` is the run-length form of the bitmap over the document's lines: an array
    of ``(start, n)``, the stretches that stay, in order; empty if none does.  A key
    loses all its lines, also those it has several times in one text, except in the
    largest ``doc_id`` holding it.  Rows that share a ``doc_id`` are one document; null
    is an id of its own, smaller than any other.  An empty table gives an empty result.
    """
    rows = written(line_rows(pick(docs, doc_id=id_col, text=text_col), min_chars), "lines")
    held = first_occurrences(rows, min_docs).groupBy("digest").agg(
        F.max(F.struct("doc_id")).alias("keep"), F.collect_set(F.struct("doc_id")).alias("docs"),
        F.collect_set("salt").alias("salts"))  # at most min_docs * SALTS documents
    common = held.where(F.size("docs") >= min_docs) \
        .select("digest", F.explode("salts").alias("salt"), F.col("keep.doc_id").alias("keep_id"))
    gone = rows.join(common, ["digest", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))) \
        .groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("gone"))
    edges = F.zip_with(F.concat(F.array(F.lit(-1)), "gone"), F.concat("gone", F.array("n_lines")),
                       lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("n")))
    return gone.select("doc_id", "text_key", F.size("gone").cast("long").alias("n_dropped"),
                       F.filter(edges, lambda r: r["n"] > 0).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text)`` of every row of ``(doc_id, text)``, ``text`` without the lines it loses.

    A document without a bitmap keeps its text; a null text is one empty line.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_key"))
    found = bitmaps.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_dropped", "keep")
    both = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    kept = F.array_join(F.flatten(F.transform("keep", lambda r: F.slice(_lines(F.col("text")), r["start"] + 1, r["n"]))), "\n")
    return both.select("doc_id", (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                       F.when(F.col("keep").isNull(), F.col("text")).otherwise(kept).alias("text"))


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_dropped`` and the ``text`` that stays.

    See ``line_bitmaps`` for which lines go.  Texts are split at ``\\n``, so a null or
    empty text has one empty line; texts of any length are read whole.  Repeated rows
    give repeated results; further columns, also of clashing names, do no harm.
    """
    return apply_bitmaps(pick(docs, doc_id=id_col, text=text_col), line_bitmaps(docs, text_col, id_col, min_chars, min_docs))
