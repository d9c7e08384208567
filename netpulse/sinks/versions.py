"""Versions of a table: one small committed file per version that names what the version holds.

The file is the commit.  It appears by one rename, so a writer that is lost before it
leaves data that no version names, and a reader holds on to the version it opened.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def manifest_path(root: str, version: int) -> str:
    return f"{root}/manifest/version={version:012d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, path = folder(spark, f"{root}/manifest")
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def commit(spark: SparkSession, root: str, version: int, entries: list[dict]) -> None:
    """Write a version's entries; a version that is there already is an error."""
    rows = [(json.dumps(e),) for e in entries]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("errorifexists").text(manifest_path(root, version))


def entries(spark: SparkSession, root: str, version: int) -> list[dict]:
    return [json.loads(r[0]) for r in spark.read.text(manifest_path(root, version)).collect()]


def drop_versions(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Delete all manifests but the newest ``keep``; returns those that stay."""
    known = versions(spark, root)
    for v in known[:-keep]:
        fs, path = folder(spark, manifest_path(root, v))
        fs.delete(path, True)
    return known[-keep:]
