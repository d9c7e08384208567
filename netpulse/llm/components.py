"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _pull_to_minimum(pairs: DataFrame) -> DataFrame:
    """For each node ``u`` of ``pairs(u, v)``: each row with the minimum of ``u`` and its ``v``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")) \
        .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _pull_to_minimum(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pulled = _pull_to_minimum(down)
    return pulled.select(F.col("v").alias("a"), F.col("m").alias("b")) \
        .unionByName(pulled.select(F.col("u").alias("a"), F.col("m").alias("b"))) \
        .where("a != b").distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node reachable.

    Only counts and a checksum reach the driver.  Each round is written to the
    shared folder, so the plan does not grow and a lost executor costs one round.
    The number of rounds grows with the logarithm of the longest path.
    """
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    seen = _signature(edges)
    while seen[0]:
        edges = written(small_star(large_star(edges)), "edges")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
