"""Bloom filter of a key list, for look-ups whose list is too long to broadcast.

The filter is a bitmap of bounded size built by aggregation: each key sets two bits,
every 32,768 bits are one row of 4 KB.  Only that bitmap is broadcast.  Rows whose bits
are not both set have no partner and are dropped where they are, so just the rows that
match, and the few that collide, cross the exchange of the join that follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size bound of the broadcast bitmap, and the bits per key that are asked for below it.
MAX_BYTES, BITS_PER_KEY = 8 << 20, 16
SLICE_BITS = 32_768


def bitmap_bits(n_keys: int, max_bytes: int = MAX_BYTES) -> int:
    """Bits of the filter: a power of two, about ``BITS_PER_KEY`` per key, within ``max_bytes``."""
    bits = SLICE_BITS
    while bits < n_keys * BITS_PER_KEY and bits * 2 <= max_bytes * 8:
        bits *= 2
    return bits


def _places(key: Column, bits: int) -> list[Column]:
    h = F.xxhash64(key)
    return [F.pmod(h, F.lit(bits)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(bits))]


def bloom_bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``(slice, bitmap)`` of the keys: at most ``bits / 32768`` rows of 4 KB."""
    place = keys.select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    return place.groupBy(F.expr(f"place div {SLICE_BITS}").alias("slice")) \
        .agg(F.bitmap_construct_agg(F.col("place") % SLICE_BITS).alias("bitmap"))


def bloom_filter(rows: DataFrame, keys: DataFrame, key: str, n_keys: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows whose ``key`` may be in ``keys``: all that are, and a small share of the others.

    ``n_keys`` is the number of keys (it sets the size of the bitmap, up to ``max_bytes``).
    A null key is in no list.
    """
    bits = bitmap_bits(n_keys, max_bytes)
    bitmap = F.broadcast(bloom_bitmap(keys.select(key), key, bits))
    names = rows.columns

    def probe(kept: DataFrame, place: Column) -> DataFrame:
        byte = F.expr(f"conv(hex(substring(bitmap, int((_place % {SLICE_BITS}) div 8) + 1, 1)), 16, 10)").cast("int")
        bit = byte.bitwiseAND(F.expr("shiftleft(1, int(_place % 8))"))
        return kept.withColumn("_place", place).join(bitmap, F.expr(f"_place div {SLICE_BITS}") == F.col("slice")) \
            .where(bit != 0).select(*names)

    return reduce(probe, _places(F.col(key), bits), rows.where(F.col(key).isNotNull()))
