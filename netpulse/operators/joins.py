"""Key look-ups with join semantics: routing, allow-lists, registries, key maps.

Small key tables are broadcast only behind a counted bound
(``bounded_broadcast``).  Above the bound a Bloom filter of bounded size drops the rows
without a partner first (``lookup_join``), and the rest meets its keys in a shuffle
join, which adaptive execution may still turn into a broadcast from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import dense_index, pseudo_ip
from ..session import checkpoint_root
from .bloom import bloom_filter

DEFAULT_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``small`` for broadcast only if it has at most ``max_rows`` rows.

    The check is a plain count: one number per partition meets in the last task,
    where a limit would gather up to ``max_rows`` rows of every partition.
    """
    return F.broadcast(small) if small.count() <= max_rows else small


def lookup_join(df: DataFrame, small: DataFrame, key: str, how: str, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Inner or left-semi join of many rows with a key table, ``key`` unique in it.

    Up to ``max_rows`` keys the table is broadcast and the rows stay where they are;
    beyond, only the rows that pass the keys' Bloom filter are shuffled.
    """
    n = small.count()
    if n <= max_rows:
        return df.join(F.broadcast(small), key, how)
    if how == "left_semi":  # as an inner join with unique keys, since a semi-join would be moved below the filter
        return bloom_filter(df, small, key, n).join(small.select(key), key)
    return bloom_filter(df, small, key, n).join(small, key, how)


def partition_map(logs: DataFrame, key: str = "src_ip", arrival: str = "event_id",
                  num_partitions: int | None = None, method: str = "ordinal") -> DataFrame:
    """Key -> partition ordinal, numbered 0..n-1 by first appearance.

    With ``num_partitions`` the ordinal is folded onto that many partitions.
    ``method="hash"`` skips the numbering and uses ``pmod(xxhash64(key), n)``:
    no ordering pass, stable for a key whatever else arrives.
    """
    if method == "hash":
        if not num_partitions:
            raise ValueError("method='hash' needs num_partitions")
        return logs.select(key).distinct().select(
            key, F.pmod(F.xxhash64(F.col(key)), F.lit(num_partitions)).cast("int").alias("partition"))
    first = logs.groupBy(key).agg(F.min(arrival).alias("_first"))
    m = dense_index(first, [F.col("_first"), F.col(key)], "partition").select(key, "partition")
    if num_partitions:
        m = m.withColumn("partition", F.pmod(F.col("partition"), F.lit(num_partitions)))
    return m.withColumn("partition", F.col("partition").cast("int"))


def route_to_partition(logs: DataFrame, pmap: DataFrame, key: str = "src_ip",
                       max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Attach the partition of each record's key; unknown keys are dropped."""
    return lookup_join(logs, pmap, key, "inner", max_rows)


def unrouted_rows(logs: DataFrame, pmap: DataFrame, key: str = "src_ip",
                  max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Records whose key has no partition (the ones routing drops)."""
    return logs.join(bounded_broadcast(pmap.select(key), max_rows), key, "left_anti")


def filter_allowlist(df: DataFrame, allow: DataFrame | list[str], key: str = "src_ip",
                     max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Keep rows whose key is in the allow-list (a list literal or a key table)."""
    if isinstance(allow, list):
        return df.where(F.col(key).isin(allow))
    return lookup_join(df, allow.select(key).distinct(), key, "left_semi", max_rows)


def registered_only(df: DataFrame, registry: DataFrame, df_key: str = "ip", reg_key: str = "src_ip",
                    max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of registered keys only (what a label-filtered range scan sees)."""
    reg = registry.select(F.col(reg_key).alias(df_key)).distinct()
    return lookup_join(df, reg, df_key, "left_semi", max_rows)


def pseudonym_map(df: DataFrame, key: str, salt: str, max_rounds: int = 64, octets: int = 4) -> DataFrame:
    """Distinct key -> unique pseudo-IP.

    ``salt`` has no default: with a known salt the few billion addresses could be
    tried one by one, so the caller keeps it secret.
    Round 0 hashes every key.  Keys that share a pseudo-IP with a smaller key
    are re-hashed with the next round number until no collision is left; each
    round checkpoints the map so its lineage stays short and the source is
    read once.  Only counts reach the driver.
    """
    checkpoint_root(df.sparkSession)
    # one row per distinct key, written once: the collision checks, the
    # broadcast bound and the join read it instead of re-deriving it
    m = df.select(key).distinct().withColumn("pseudo", pseudo_ip(key, salt, 0, octets)) \
        .withColumn("_round", F.lit(0)).checkpoint(eager=True)
    for r in range(1, max_rounds + 1):
        owner = m.groupBy("pseudo").agg(F.min(key).alias("_owner"))
        losers = m.join(owner, "pseudo").where(F.col(key) != F.col("_owner")).select(key)
        if losers.limit(1).count() == 0:
            return m.select(key, "pseudo")
        redo = m.join(losers, key, "left_semi") \
            .withColumn("pseudo", pseudo_ip(key, salt, r, octets)).withColumn("_round", F.lit(r))
        m = m.join(losers, key, "left_anti").unionByName(redo).checkpoint(eager=True)
    raise RuntimeError("pseudonym collisions left after max_rounds")


def replace_keys(df: DataFrame, mapping: DataFrame, key: str = "src_ip", new: str = "pseudo",
                 check: bool = True, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace ``key`` by its mapped value; a key missing from the map is an error."""
    m = bounded_broadcast(mapping.select(key, new), max_rows)
    if check:
        # distinct keys first (combined map-side), not an anti-join over every row
        missing = df.select(key).distinct().join(m, key, "left_anti").limit(1).count()
        if missing:
            raise KeyError(f"keys of {key} missing from the value map")
    cols = [F.col(new).alias(key) if c == key else F.col(c) for c in df.columns]
    return df.join(m, key, "inner").select(*cols)
