"""Ways to keep one heavy group out of a single task."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.constants import (
    BROADCAST_KEYS,
    CHUNK_ROWS,
    FEW_CHUNKS,
    MAX_CHUNKS,
    SMALL_CHUNK_ROWS,
    TASK_ROWS,
)
from riskweave.session import checkpoint_dir, materialize

CHUNK = "__chunk"


@dataclass(frozen=True)
class HeavySplit:
    light: DataFrame
    heavy: DataFrame | None
    heavy_rows: int


def null_safe_join(
    df: DataFrame, other: DataFrame, on: str | list[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which NULL equals NULL; the columns of ``on`` come from ``df``."""
    names = [on] if isinstance(on, str) else on
    renamed = other.withColumnsRenamed({c: f"__right_{c}" for c in names})
    same = [F.col(c).eqNullSafe(F.col(f"__right_{c}")) for c in names]
    return df.join(renamed, same, how).drop(*[f"__right_{c}" for c in names])


def semi_join(df: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join with a key list, broadcast only if a count shows it short.

    NULL is a key like any other. A longer list is joined by shuffle, where adaptive
    execution splits skewed partitions of ``df``.
    """
    short = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return null_safe_join(df, F.broadcast(keys) if short else keys, on, how)


def join_short(
    df: DataFrame, small: DataFrame, on: str | list[str], how: str = "left"
) -> DataFrame:
    """Join with a side that is usually short; it is computed once and counted.

    Short, it is broadcast and ``df`` stays where it is; otherwise both are shuffled.
    NULL matches NULL.
    """
    checkpoint_dir(df.sparkSession)
    kept = small.checkpoint()
    short = kept.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return null_safe_join(df, F.broadcast(kept) if short else kept, on, how)


def split_heavy(df: DataFrame, key: str, limit: int) -> HeavySplit:
    """Separate the groups with more than ``limit`` rows.

    One job counts rows per key, with map-side partial counts, over the key column
    only. There are at most rows / ``limit`` heavy keys.
    """
    heavy = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    found = heavy.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    if not found["keys"]:
        return HeavySplit(df, None, 0)
    checkpoint_dir(df.sparkSession)
    keys = heavy.select(key).checkpoint()
    return HeavySplit(
        semi_join(df, keys, key, "left_anti"), semi_join(df, keys, key), int(found["rows"])
    )


def in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of ``rows`` rows, hashed by ``keys`` into tasks of some ``TASK_ROWS``.

    Adaptive execution joins partitions by their compressed bytes; rows that compress well
    would meet by the million in tasks that hold them uncompressed. It leaves a given number
    of partitions alone.
    """
    return df.repartition(min(max(1, math.ceil(rows / TASK_ROWS)), MAX_CHUNKS), *keys)


def chunk_count(rows: int, chunk_rows: int, shuffle_partitions: int) -> int:
    """Chunks of ``chunk_rows``, or smaller ones while the cluster would idle otherwise.

    A chunk is sorted with spilling, so it may grow: past FEW_CHUNKS to SMALL_CHUNK_ROWS, as
    every chunk is a task and a file and sends a sample of keys to the driver, and where the
    number of chunks reaches what one range shuffle handles well.
    """
    small = math.ceil(rows / SMALL_CHUNK_ROWS)
    wanted = min(math.ceil(rows / chunk_rows), max(FEW_CHUNKS, small))
    return min(max(2, wanted, min(shuffle_partitions, small)), MAX_CHUNKS)


def range_chunks(
    df: DataFrame, order: list[str | Column], rows: int, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Cut ``df`` into contiguous ranges of ``order``, numbered in column ``__chunk``.

    With a unique ``order`` no group is too heavy to cut. The bounds come from a
    sample, so the result is written to the shared folder: every reader must see the
    same chunks, also after a lost executor, and each reads only its columns.
    """
    spark = df.sparkSession
    parts = chunk_count(rows, chunk_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = df.repartitionByRange(parts, *order).withColumn(CHUNK, F.spark_partition_id())
    return materialize(cut, "chunks")


def before_chunk(group: str) -> W:
    """Window over the one-row-per-(group, chunk) summaries that precede a chunk."""
    return W.partitionBy(group).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
