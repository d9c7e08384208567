"""Decoding of wire records (JSON text of string fields) into log columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LOG_FIELDS, LOG_SCHEMA, LOG_STREAM_SCHEMA, TIMESTAMP_FORMAT


def decode_payload(records: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                   fields: list[str] | None = None) -> DataFrame:
    """Parse the JSON value by the fixed wire schema and flatten ``data.*``.

    Unknown fields are dropped, missing ones are null and a malformed record
    becomes a row of nulls (PERMISSIVE).  ``fields`` narrows the parsed schema
    to what the caller reads, so only those fields are materialised.
    """
    keep = keep if keep is not None else [c for c in records.columns if c != value_col]
    schema = LOG_STREAM_SCHEMA if not fields else T.StructType(
        [f for f in LOG_STREAM_SCHEMA.fields if f.name in fields])
    parsed = records.select(*keep, F.from_json(F.col(value_col).cast("string"), schema,
                                               {"mode": "PERMISSIVE"}).alias("data"))
    return parsed.select(*keep, *[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields])


def tolerant_number(c: str | Column, to: str = "double") -> Column:
    """String to number without failing the job: bad text becomes null.

    Spark 4 runs with ANSI mode on, where an implicit cast of a bad string
    raises; ``try_cast`` keeps the lenient behaviour of a log pipeline.
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(to)


def type_payload(decoded: DataFrame) -> DataFrame:
    """Typed log columns from decoded string fields (bad values become null)."""
    out = []
    for f in LOG_SCHEMA.fields:
        if f.name == "src_ip":
            out.append(F.col("src_ip"))
        elif f.name == "timestamp":
            out.append(F.try_to_timestamp(F.col("timestamp"), F.lit(TIMESTAMP_FORMAT))
                       .cast("timestamp_ntz").alias("timestamp"))
        else:
            out.append(tolerant_number(f.name, f.dataType.simpleString()).alias(f.name))
    rest = [c for c in decoded.columns if c not in LOG_FIELDS]
    return decoded.select(*rest, *out)


def split_malformed(records: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(decoded, quarantine)``: records whose text is not a JSON object go to
    the quarantine frame with their raw value, the rest are decoded.  The
    check is a parse into a string map, with no shuffle and no driver step."""
    parsed = records.withColumn("_doc", F.from_json(F.col(value_col).cast("string"),
                                                    T.MapType(T.StringType(), T.StringType()),
                                                    {"mode": "PERMISSIVE"}))
    good = decode_payload(parsed.where(F.col("_doc").isNotNull()).drop("_doc"), value_col)
    bad = parsed.where(F.col("_doc").isNull()).drop("_doc")
    return good, bad
