"""Joins on either side of the broadcast limit, and chunks of bounded size."""

from __future__ import annotations

import pytest
from conftest import frame, txn
from pyspark.sql import functions as F

from riskweave.operators import skew


@pytest.mark.parametrize("limit", [0, 100])
def test_semi_and_left_joins_do_not_depend_on_the_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", limit)
    df = spark.range(50).select((F.col("id") % 10).alias("k"), "id")
    keys = spark.range(3).select(F.col("id").alias("k"))
    assert skew.semi_join(df, keys, "k").count() == 15
    assert skew.semi_join(df, keys, "k", "left_anti").count() == 35
    tagged = skew.join_short(df, keys.withColumn("tag", F.lit(1)), "k")
    assert tagged.filter("tag = 1").count() == 15 and tagged.count() == 50


def test_split_heavy(spark):
    rows = [txn(f"h{i}", "hot", seconds=i) for i in range(30)]
    rows += [txn(f"c{i}", f"a{i}", seconds=i) for i in range(60)]
    split = skew.split_heavy(frame(spark, rows), "account_id", 10)
    assert split.heavy_rows == 30 and split.heavy.count() == 30 and split.light.count() == 60
    assert skew.split_heavy(frame(spark, rows), "account_id", 30).heavy is None


def test_chunks_are_bounded_even_within_one_instant(spark):
    rows = [txn(f"k{i:05d}", "hot") for i in range(4000)]
    order = ["account_id", "occurred_at", "idempotency_key"]
    chunks = skew.range_chunks(frame(spark, rows), order, 4000, 500)
    sizes = [r["count"] for r in chunks.groupBy(skew.CHUNK).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 2 * 500
    spans = (
        chunks.groupBy(skew.CHUNK)
        .agg(F.min("idempotency_key").alias("lo"), F.max("idempotency_key").alias("hi"))
        .orderBy(skew.CHUNK)
        .collect()
    )
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_chunk_count():
    assert skew.chunk_count(10, 1_000_000, 200) == 2
    assert skew.chunk_count(2_000_000, 1_000_000, 32) == 32
    assert skew.chunk_count(2_000_000, 1_000_000, 4000) == 40
    assert skew.chunk_count(10**9, 1_000_000, 4000) == 4000
    assert skew.chunk_count(10**12, 1_000_000, 4000) == 20_000


def test_small_chunks_do_not_grow_in_number_with_the_rows():
    """A chunk of a few hundred rows is a task, a file and a sample at the driver."""
    assert skew.chunk_count(4000, 500, 4) == 8
    assert skew.chunk_count(240_000, 700, 8) == 200
    assert skew.chunk_count(24_000_000, 700, 8) == 480
    assert skew.chunk_count(144_000_000, 500, 8) == 2880
