"""Deduplication by idempotency key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, *order: str | Column, key: str = "idempotency_key") -> DataFrame:
    """Keep the first row per key in ``order``.

    ``row_number() = 1`` is planned with a partial group limit before the shuffle:
    each map task sends at most one row per key, so a key that holds a third of
    the rows costs the reducer one row per map task.
    """
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def dedupe_feed(df: DataFrame) -> DataFrame:
    """First serving of each record of a paged feed."""
    return dedupe_first(df, "page_no", "pos").drop("page_no", "pos")


def not_in_store(batch: DataFrame, store: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """Rows whose key the store does not hold; only the key column is read from it.

    ``batch`` must already be deduplicated. No broadcast hint: the store grows.
    """
    return batch.join(store.select(key), key, "left_anti")


def dedupe_against_store(batch: DataFrame, store: DataFrame, *order: str | Column) -> DataFrame:
    """New keys of a batch, one row each."""
    return not_in_store(dedupe_first(batch, *order), store)


def batch_tally(batch: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of a batch per outcome: ``accepted``, ``duplicate``, ``invalid``.

    ``batch`` carries ``error``. Rows are counted per key map-side first, so a hot
    key is one row in the join with the store. Accepted counts real inserts.
    """
    good = F.col("error").isNull()
    per_key = batch.groupBy("idempotency_key").agg(
        F.count_if(good).alias("good"), F.count_if(~good).alias("bad")
    )
    known = store.select("idempotency_key", F.lit(True).alias("known"))
    new = (F.col("good") > 0) & F.col("known").isNull()
    totals = (
        per_key.join(known, "idempotency_key", "left")
        .agg(
            F.count_if(new).alias("accepted"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid"),
        )
        .withColumn("duplicate", F.col("good") - F.col("accepted"))
    )
    names = ("accepted", "duplicate", "invalid")
    return totals.select(
        F.inline(F.array(*[F.struct(F.lit(x).alias("outcome"), F.col(x).alias("n")) for x in names]))
    )
