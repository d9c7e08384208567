"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path

#: Rows per bitmap, 4 KB of a bit each (a fixed value of the bitmap functions), and bitmaps that may be broadcast: 64 MB.
MARK_ROWS = 1 << 15
BROADCAST_MARKS = (64 << 20) // (MARK_ROWS // 8)
#: Whether a query's shuffle files go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(df: DataFrame, name: str) -> int:
    """Place of a column: its exact name, else the first that differs in case only."""
    if name in df.columns:
        return df.columns.index(name)
    return [c.lower() for c in df.columns].index(name.lower())


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names: ``pick(df, doc_id="doc_id", text="body")``.

    Columns are taken by position of their exact name, so further columns of any
    name, also names that differ in case only, do no harm.
    """
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[plain[f"_c{position(df, src)}"].alias(dst) for dst, src in columns.items()])


def written(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of these files, not the
    work that led to them, and several readers share one computation.  ``free``
    drops the shuffle files that led to them as soon as they are written; otherwise
    these stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, str(free or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _is_file_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` is a bare Parquet table, whose rows have a place in a file of their own."""
    relation = docs._jdf.queryExecution().analyzed()
    return relation.getClass().getSimpleName() == "LogicalRelation" and "parquet" in relation.simpleString(25) \
        and "_metadata" not in map(str.lower, docs.columns)


def keep_rows(docs: DataFrame, decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``decide`` keeps, each decided for itself, with all their columns.

    ``decide`` takes the rows with their key in a further column, and that column's
    name; it returns the keys that stay, in a single column.  The key of a table's row
    is its place, file and index; the rows of any other frame are written first.
    So decisions and rows share the keys whatever is computed anew, and neither
    repeated nor null ids bring another row back.

    The keys that stay become bitmaps, one per file and ``MARK_ROWS`` rows, written
    once.  Up to ``BROADCAST_MARKS`` of them, a bit per row, are broadcast, and the rows
    with their texts cross no shuffle; beyond, rows and bitmaps are joined by a shuffle.
    """
    key = "__row"
    while key in map(str.lower, docs.columns):
        key += "_"
    names = [f"_c{i}" for i in range(len(docs.columns))]
    stored = docs if _is_file_scan(docs) else written(docs.toDF(*names), "rows")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    rows = stored.select("*", F.struct(*place)).toDF(*docs.columns, key)
    # a row's number within its file, from 1 as the bitmap functions count
    kept = decide(rows, key).toDF("kept").select("kept.file", (F.col("kept.at") + 1).alias("number"))
    marks = written(kept.groupBy("file", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("marks")), "marks")
    if marks.count() <= BROADCAST_MARKS:
        marks = F.broadcast(marks)
    number = (F.col("_metadata.row_index") + 1).alias("number")
    found = stored.select("*", place[0], number).toDF(*names, "file", "number") \
        .withColumn("bucket", F.bitmap_bucket_number("number")).join(marks, ["file", "bucket"])
    byte = F.conv(F.hex(F.expr("substring(marks, cast(bitmap_bit_position(number) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return found.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(number) % 8 as int))")) != 0) \
        .select(*names).toDF(*docs.columns)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
