"""Bloom filters as tables: which keys may be known, without reading any key.

A filter is rows of 32,768 bits. A key belongs to one row, by bucket and block, and sets
eight bits there; it may be known only if all of them are set. Filters are built by map-side
bitmap aggregation and read like any other table; several are asked side by side, so they
need not have the same size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 32_768
BITS_A_KEY = 32
PROBES = 8

FILTER = T.StructType(
    [
        T.StructField("blocks", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def block_count(keys: int, buckets: int) -> int:
    """Blocks of each bucket for so many keys: a power of two, so few sizes exist."""
    wanted = max(1.0, keys * BITS_A_KEY / (BLOCK_BITS * buckets))
    return 1 << math.ceil(math.log2(wanted))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks.cast("bigint")).cast("int")


def _probes(key: Column) -> Column:
    """Eight places in a block, four from each of two hashes."""
    places = [
        F.shiftrightunsigned(F.xxhash64(key, F.lit(f"probe {h}")), 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1))
        for h in range(2)
        for k in range(PROBES // 2)
    ]
    return F.array(*places)


def build_filter(keys: DataFrame, blocks: int, *, key: str, bucket: str) -> DataFrame:
    """The filter of the keys in column ``key``; ``bucket`` comes along. NULL sets no bit."""
    size = F.lit(blocks)
    placed = keys.filter(F.col(key).isNotNull()).select(
        bucket,
        size.alias("blocks"),
        _block(F.col(key), size).alias("block"),
        F.explode(_probes(F.col(key))).alias("place"),
    )
    return placed.groupBy(bucket, "blocks", "block").agg(
        F.bitmap_construct_agg("place").alias("bits")
    )


def may_be_known(keys: DataFrame, filters: DataFrame, *, key: str, bucket: str) -> DataFrame:
    """The rows of ``keys``, once each, that some filter does not rule out.

    ``keys`` is unique by key. A filter of another size has a row of its own for a key, so
    the keys are placed once for every size that occurs; sizes are powers of two.
    """
    # Powers of two: a few dozen at most.
    sizes = [F.lit(r["blocks"]) for r in filters.select("blocks").distinct().collect()]
    if not sizes:
        return keys.limit(0)
    one = F.struct(*keys.columns).alias("one")
    placed = (
        keys.select(one, F.col(key).alias("__key"), F.col(bucket).alias("__bucket"))
        .withColumn("blocks", F.explode(F.array(*sizes)))
        .withColumn("__block", _block(F.col("__key"), F.col("blocks")))
        .withColumn("__probes", _probes(F.col("__key")))
    )
    rows = filters.select(F.col(bucket).alias("__bucket"), "blocks", F.col("block").alias("__block"), "bits")
    byte = lambda place: F.substring(F.col("bits"), (place / 8).cast("int") + 1, F.lit(1))
    is_set = lambda place: F.getbit(
        F.conv(F.hex(byte(place)), 16, 10).cast("int"), (place % 8).cast("int")
    ) == 1
    hit = placed.join(rows, ["__bucket", "blocks", "__block"]).filter(F.forall("__probes", is_set))
    return hit.groupBy("__key").agg(F.first("one").alias("one")).select("one.*")
