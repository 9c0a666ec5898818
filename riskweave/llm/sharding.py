"""Sharding by Hilbert order: rows near in several dimensions share a shard.

Metadata columns are quantised to a few bits each, the cell of a row gives its place on a
Hilbert curve, rows are sorted by that place, and the sorted rows are cut into runs of
equal length. The rank of a row is its place in a range-sorted table that has been written
down, plus the rows of the ranges before; no task sees more than its own range.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from riskweave.session import materialize

SHARDS = 40
BITS = 5
ROW_OVERHEAD = 16
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)
DIMENSIONS = ("source", "lang", "size")
_WHOLE = ("tinyint", "smallint", "int", "bigint", "boolean")
_TIMES = ("date", "timestamp")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows by dimensions, 0 to 2^bits - 1).

    Works from the highest bit down: the cell's half in each dimension, read as a Gray
    code, is the next digit; then the axes are mirrored and swapped into the frame of
    the half-size cube.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swapped = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swapped)
            if i:
                x[i] ^= swapped
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def _curve(bits: int):
    @arrow_udf("bigint")
    def curve(cells: pa.Array) -> pa.Array:
        width = len(cells.type)
        rows = np.stack([np.asarray(cells.field(i)) for i in range(width)], axis=1)
        return pa.array(hilbert_index(rows, bits), pa.int64())

    return curve


def order_value(docs: DataFrame, name: str) -> Column:
    """What the column is cut by: whole numbers, dates and instants as a long, else as it is.

    Texts are compared as whole values, byte by byte; NaN is the largest number.
    """
    kind = dict(docs.dtypes)[name]
    value = F.col(name)
    if kind == "date":
        value = F.unix_date(value)
    elif kind == "timestamp":
        value = F.unix_micros(value)
    return value.cast("bigint") if kind in (*_WHOLE, *_TIMES) else value


def quantile_bounds(table: DataFrame, names: list[str], bits: int) -> dict[str, list]:
    """Up to 2^bits - 1 distinct cut values per column, from all its rows that have one."""
    kinds = dict(table.dtypes)
    whole = [n for n in names if kinds[n] == "bigint"]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = {}
    if whole:
        row = table.agg(*[F.percentile_approx(n, steps, 10_000).alias(n) for n in whole]).first()
        found = {n: sorted(set(row[n] or [])) for n in whole}
    return {n: found[n] if n in found else _value_bounds(table, n, bits) for n in names}


def _value_bounds(table: DataFrame, name: str, bits: int) -> list:
    """The values at which the share of the rows passes a multiple of 2^-bits.

    Rows are counted by value first, so a value that many rows share is one row per task.
    Counts run up inside sorted ranges; only the cut values come to the driver.
    """
    counted = table.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    ranged = materialize(
        counted.repartitionByRange("value")
        .sortWithinPartitions("value")
        .withColumn("part", F.spark_partition_id()),
        "shard-counts",
    )
    # One row per range.
    by_range = Window.orderBy("part")
    parts = ranged.groupBy("part").agg(F.sum("n").alias("rows"))
    offsets = parts.select(
        "part",
        (F.sum("rows").over(by_range) - F.col("rows")).alias("before"),
        F.sum("rows").over(by_range.rowsBetween(*_ALL)).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = (
        ranged.withColumn("inside", F.sum("n").over(inside))
        .join(F.broadcast(offsets), "part")
        .withColumn("upto", F.col("before") + F.col("inside"))
    )
    share = [F.expr(f"({end} * {1 << bits}) div total") for end in ("(upto - n)", "upto")]
    cuts = upto.where((share[0] < share[1]) & (F.col("upto") < F.col("total"))).orderBy("value")
    return [r["value"] for r in cuts.select("value").collect()]


def _level(name: str, bounds: list) -> Column:
    """How many cut values lie below the value; none for a null."""
    above = [F.coalesce(F.col(name) > F.lit(b), F.lit(False)).cast("int") for b in bounds]
    return reduce(lambda a, b: a + b, above, F.lit(0))


def hilbert_order(
    docs: DataFrame, dimensions: tuple[str, ...], keep: list[str], bits: int = BITS
) -> DataFrame:
    """``keep`` and ``hilbert`` of every row, written down, with its rank from 0 as ``rank``.

    Rows of one cell are ordered by the columns in ``keep``. ``n_rows`` is their number.
    """
    ordered = [order_value(docs, d).alias(f"_v{i}") for i, d in enumerate(dimensions)]
    names = [f"_v{i}" for i in range(len(dimensions))]
    values = materialize(docs.select(*keep, *ordered), "shard-values")
    bounds = quantile_bounds(values, names, bits)
    cells = F.struct(*[_level(n, bounds[n]).alias(n) for n in names])
    placed = values.select(*keep, _curve(bits)(cells).alias("hilbert"))
    ranged = materialize(
        placed.repartitionByRange("hilbert", *keep)
        .sortWithinPartitions("hilbert", *keep)
        .withColumn("_at", F.monotonically_increasing_id()),
        "shard-order",
    )
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per range: the only window without a partition, as long as there are ranges.
    by_range = Window.orderBy("_part")
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(by_range) - F.col("_n")).alias("_before"),
        F.sum("_n").over(by_range.rowsBetween(*_ALL)).alias("n_rows"),
    )
    row = F.col("_at") - F.shiftleft("_part", 33)
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*keep, "hilbert", (row + F.col("_before")).alias("rank"), "n_rows")
    )


def cut_runs(ranked: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``shard`` and ``slot`` from ``rank`` and ``n_rows``: runs whose lengths differ by one at most."""
    numbered = ranked.withColumn("shard", F.expr(f"int(({shards} * (rank + 1) - 1) div n_rows)"))
    return numbered.withColumn("slot", F.expr(f"rank - (cast(shard as bigint) * n_rows) div {shards}"))


def shard(
    docs: DataFrame,
    keep: list[str],
    dimensions: tuple[str, ...] = DIMENSIONS,
    *,
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """``keep``, hilbert, shard and slot of every row; slots count from 0 without a gap.

    Rows that are equal in all of ``keep`` change places freely. With fewer rows than
    shards some shards stay empty; an empty table gives an empty table.
    """
    ranked = cut_runs(hilbert_order(docs, dimensions, keep, bits), shards)
    return ranked.select(*keep, "hilbert", "shard", "slot")


def write_shards(docs: DataFrame, path: str, dimensions: tuple[str, ...], **settings) -> DataFrame:
    """Writes whole rows by shard folder, in curve order, and returns the manifest.

    The manifest has the rows and the least and largest value of each dimension per shard.
    """
    made = shard(docs, [*dimensions, *(c for c in docs.columns if c not in dimensions)], dimensions, **settings)
    made.write.partitionBy("shard").parquet(path)
    ranges = [f(d).alias(f"{n}_{d}") for d in dimensions for f, n in ((F.min, "min"), (F.max, "max"))]
    stored = docs.sparkSession.read.parquet(path)
    return stored.groupBy("shard").agg(F.count("*").alias("n_rows"), *ranges)


def shards_for(manifest: DataFrame, **ranges: tuple) -> DataFrame:
    """The shards that can hold a row inside all given (least, largest) ranges."""
    test = F.lit(True)
    for name, (least, largest) in ranges.items():
        test = test & (F.col(f"max_{name}") >= least) & (F.col(f"min_{name}") <= largest)
    return manifest.where(test)


def op4(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law ("rows"), shard, slot, grown_shard (null).

    A null text has size 16 and the checksum of an empty text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        F.crc32(text).alias("text_crc32"),
        (F.octet_length(text).cast("bigint") + ROW_OVERHEAD).alias("size"),
        "doc_id",
        "source",
        "lang",
    )
    made = shard(sized, ["text_crc32", "size", "doc_id"])
    return made.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )
