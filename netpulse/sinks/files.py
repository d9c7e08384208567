"""Writers.  Outputs go to new paths (versions); nothing overwrites the path
it reads from."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TIMESTAMP_FORMAT


def write_csv(df: DataFrame, path: str, ts_format: str = TIMESTAMP_FORMAT) -> str:
    (df.write.mode("errorifexists").option("header", True)
     .option("timestampFormat", ts_format).option("timestampNTZFormat", ts_format).csv(path))
    return path


def rows_to_json(df: DataFrame, path: str, ts_format: str = TIMESTAMP_FORMAT) -> str:
    """Each row as one JSON document, one per line (JSON lines)."""
    (df.write.mode("errorifexists").option("timestampFormat", ts_format)
     .option("timestampNTZFormat", ts_format).json(path))
    return path


def write_json_documents(df: DataFrame, path: str, docs_per_file: int = 50_000, ts_format: str = TIMESTAMP_FORMAT) -> str:
    """Each row as one pretty-printed JSON document, about ``docs_per_file`` of them in the array that makes up a file.

    A file of many-line JSON is read by one task, so the rows are dealt evenly over as
    many files as that bound asks for, whatever keys they hold.
    """
    files = max(1, -(-df.count() // docs_per_file))
    pretty = {"pretty": "true", "timestampFormat": ts_format, "timestampNTZFormat": ts_format, "ignoreNullFields": "false"}

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "[\n"
        for b in batches:
            docs = []
            for doc in b.column(0).to_pylist():
                docs.append(lead + doc)
                lead = ","
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead != "," else "]"])], names=["value"])

    docs = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), pretty).alias("value"))
    docs.repartition(files).mapInArrow(bracketed, "value string").write.mode("errorifexists").text(path)
    return path


def json_records(df: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, value)`` records: the row as a JSON object (topic payload)."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    cols = [value.alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def write_history(df: DataFrame, path: str, data_type: str) -> str:
    """Append the history rows ``(ip, ds, y)`` of one metric; what is there is not touched.

    The table is partitioned by metric and day.  Range partitioning on (day, ip, ds)
    splits a hot source over several files, each holding a sorted range.
    """
    rows = df.select("ip", "ds", "y", F.lit(data_type).alias("data_type"), F.to_date("ds").alias("day"))
    (rows.repartitionByRange("day", "ip", "ds").sortWithinPartitions("day", "ip", "ds")
     .write.mode("append").partitionBy("data_type", "day").parquet(path))
    return path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_batch_idempotent(df: DataFrame, path: str, batch_id: int) -> None:
    """Per-micro-batch writer keyed by ``batch_id``: a replayed batch replaces
    its own partition and leaves the table unchanged."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def kafka_records(df: DataFrame, key: str, partition: str | None = None) -> DataFrame:
    """Projection for a Kafka sink: ``key``, JSON ``value`` and an optional explicit ``partition``."""
    payload = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != partition]))
    cols = [F.col(key).cast("string").alias("key"), payload.alias("value")]
    if partition:
        cols.append(F.col(partition).cast("int").alias("partition"))
    return df.select(*cols)


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``key``/``value``[/``partition``] records (needs the Kafka connector)."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                num_partitions: int | None = None) -> None:
    """Append rows to a relational table (run ``append_new_only`` first to
    make a retried dump harmless).  ``num_partitions`` caps concurrent
    connections to the database."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.mode("append").jdbc(url, table, properties=properties or {})
