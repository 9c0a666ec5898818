"""The keys of all stored transactions, remembered for ever.

The exact index holds one column by micro-batch and key bucket. In front of it stand Bloom
filters: a key that none of them may know is new, and nothing of the index is read for it.
Every micro-batch has a filter; eight that are complete give way to one made from their
keys, eight of those to the next, and so on. So a batch asks a number of filters that grows
with the logarithm of the batches, and a key is rewritten as seldom. Which filters exist
follows from the batch number alone, so a replay asks the same ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.bloom import FILTER, block_count, build_filter, may_be_known
from riskweave.operators.dedupe import not_in_store
from riskweave.schemas import TXN
from riskweave.session import delete_folder, materialize
from riskweave.sources.tables import (
    KEY_BUCKET,
    _exists,
    batch_ids,
    bucket_of,
    read_batches,
    read_keys,
    read_table,
    touched_buckets,
    write_batch,
    write_key_batch,
    write_transaction_batch,
)
from riskweave.streaming.store import HISTORY_BATCH, Store

#: Filters that give way to one of the next level.
FAN_IN = 8
_KEY = "idempotency_key"
_STORED = T.StructType([*FILTER.fields, T.StructField(KEY_BUCKET, T.IntegerType())])
_INDEX = T.StructType([TXN[_KEY], T.StructField(KEY_BUCKET, T.IntegerType())])


def _level(store: Store, level: int) -> str:
    return f"{store.key_filters}/level-{level}"


def current_filters(batch_id: int) -> list[tuple[int, int]]:
    """(level, group) of the filters that together cover the batches 0 to ``batch_id`` - 1."""
    found, start, level = [], 0, 0
    while FAN_IN ** (level + 1) <= batch_id:
        level += 1
    for own in range(level, -1, -1):
        size = FAN_IN**own
        while start + size <= batch_id:
            found.append((own, start // size))
            start += size
    return found


def write_filters(spark: SparkSession, store: Store, batch_id: int) -> None:
    """The filter that a batch whose keys are stored completes: its own, or a higher one.

    What a higher one replaces is deleted one batch later, when no replay asks it.
    """
    level, size = 0, 1
    while batch_id >= 0 and (batch_id + 1) % (size * FAN_IN) == 0:
        level, size = level + 1, size * FAN_IN
    group = batch_id // size
    of = range(group * size, (group + 1) * size) if level else [batch_id]
    paths = [p for b in of if _exists(spark, p := f"{store.keys}/batch_id={b}")]
    index = spark.read.schema(_INDEX).option("basePath", store.keys).parquet(*paths)
    blocks = block_count(index.count(), store.buckets)
    made = build_filter(index, blocks, key=_KEY, bucket=KEY_BUCKET)
    write_batch(made, _level(store, level), group, once=True, partition=KEY_BUCKET)
    if batch_id > 0:
        kept = {*current_filters(batch_id), *current_filters(batch_id + 1)}
        for old, gone in set(current_filters(batch_id - 1)) - kept:
            delete_folder(spark, f"{_level(store, old)}/batch_id={gone}")


def read_filters(
    spark: SparkSession, store: Store, batch_id: int, key_buckets: list[int]
) -> DataFrame | None:
    """Filters of all keys stored before a batch, in some buckets; None if there are none."""
    history = [(0, b) for b in batch_ids(spark, store.keys) if b < 0]
    paths = [f"{_level(store, n)}/batch_id={g}" for n, g in [*history, *current_filters(batch_id)]]
    for path in paths:
        if not _exists(spark, path):
            raise RuntimeError(f"{path} is missing: write_filters makes the filter of stored keys")
    if not paths:
        return None
    tables = [read_table(spark, path, _STORED) for path in paths]
    return reduce(DataFrame.unionByName, tables).filter(F.col(KEY_BUCKET).isin(*key_buckets))


def known_keys(
    rows: DataFrame, batch_id: int, store: Store
) -> DataFrame | None:
    """Those keys of ``rows`` that other batches have stored; None if there are none.

    The index is read for keys that pass a filter only, in their own buckets.
    """
    spark = rows.sparkSession
    asked = rows.select(_KEY, bucket_of(F.col(_KEY), store.buckets).alias(KEY_BUCKET))
    asked = materialize(asked.filter(F.col(_KEY).isNotNull()).distinct(), "asked-keys")
    buckets = touched_buckets(asked, _KEY, store.buckets)
    filters = read_filters(spark, store, batch_id, buckets) if buckets else None
    if filters is None:
        return None
    maybe = materialize(may_be_known(asked, filters, key=_KEY, bucket=KEY_BUCKET), "maybe-known")
    buckets = touched_buckets(maybe, _KEY, store.buckets)
    if not buckets:
        return None
    index = read_keys(spark, store.keys, buckets, batch_id)
    return index.join(maybe.select(_KEY), _KEY, "left_semi").distinct()


def store_new(rows: DataFrame, batch_id: int, store: Store) -> DataFrame:
    """Store the rows of a micro-batch whose key is new, with keys and filters; returns them.

    ``rows`` is unique by key. Each table is written once per batch, so a replay from any
    point of failure ends in the same tables.
    """
    spark = rows.sparkSession
    if not _exists(spark, f"{store.transactions}/batch_id={batch_id}/_SUCCESS"):
        known = known_keys(rows, batch_id, store)
        new = rows if known is None else not_in_store(rows, known)
        write_transaction_batch(new, store.transactions, batch_id, store.buckets)
    return read_batches(spark, store.transactions, TXN, batch_id)


def remember(new: DataFrame, batch_id: int, store: Store) -> None:
    """Add the keys of stored rows to the index and its filters: the last step of a batch."""
    write_key_batch(new, store.keys, batch_id, store.buckets)
    write_filters(new.sparkSession, store, batch_id)


def load_history(txns: DataFrame, store: Store) -> int:
    """Add existing transactions, unique by key, to a store; returns their batch number.

    Every load takes a new number below 0, so loads in parts add up. Keys that the store
    already holds are the caller's to drop. A load that broke off before its keys were
    complete is written again under the same number.
    """
    spark = txns.sparkSession
    done = [b for b in batch_ids(spark, store.keys) if _exists(spark, f"{store.keys}/batch_id={b}/_SUCCESS")]
    filtered = batch_ids(spark, _level(store, 0))
    batch = min([HISTORY_BATCH + 1, *[b for b in done if b in filtered]]) - 1
    write_transaction_batch(txns, store.transactions, batch, store.buckets)
    remember(txns, batch, store)
    return batch
