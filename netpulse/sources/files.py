"""File sources with fixed schemas: typed CSV, JSON documents, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import LOG_SCHEMA, TIMESTAMP_FORMAT


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA,
                   ts_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """CSV with a header row, typed by ``schema``.

    The format uses ``HH`` (24-hour clock): a 12-hour ``hh`` pattern turns
    13:00 into an error or null and 12:00 into 00:00.
    """
    return (spark.read.schema(schema).option("header", True)
            .option("timestampFormat", ts_format).option("timestampNTZFormat", ts_format)
            .option("mode", "PERMISSIVE").csv(path))


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType,
                        multiline: bool = True, ts_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """One JSON document, or an array of them, per file; documents may be pretty-printed over many lines."""
    return (spark.read.schema(schema).option("multiLine", multiline).option("timestampFormat", ts_format)
            .option("timestampNTZFormat", ts_format).json(path))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType,
                    ts_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    return (spark.read.schema(schema).option("timestampFormat", ts_format)
            .option("timestampNTZFormat", ts_format).json(path))
