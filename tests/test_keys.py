"""Keys remembered for ever: filters first, the index only for what passes them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_ingest import txns
from test_streams import clock, drain

from riskweave.operators.bloom import block_count, build_filter, may_be_known
from riskweave.operators.dedupe import dedupe_first
from riskweave.sources.envelopes import to_envelope
from riskweave.sources.tables import read_transactions
from riskweave.streaming import keys as keyed
from riskweave.streaming.ingest import dedupe_stream, ingest_batch
from riskweave.streaming.keys import current_filters, remember, store_new
from riskweave.streaming.store import Store


def numbered(spark, ids):
    key = F.concat(F.lit("bank:"), F.col("id").cast("string"))
    return ids.select(key.alias("k"), (F.col("id") % 3).cast("int").alias("b"))


def test_filters_miss_no_key_and_pass_few_others(spark):
    known = numbered(spark, spark.range(6000))
    small = build_filter(known.limit(0).union(numbered(spark, spark.range(500))), 1, key="k", bucket="b")
    large = build_filter(numbered(spark, spark.range(500, 6000)), block_count(5500, 3), key="k", bucket="b")
    filters = small.unionByName(large)
    assert {r.blocks for r in filters.select("blocks").distinct().collect()} == {1, 2}
    asked = numbered(spark, spark.range(40_000))
    passed = {r.k for r in may_be_known(asked, filters, key="k", bucket="b").collect()}
    assert {f"bank:{i}" for i in range(6000)} <= passed
    assert len(passed) < 6000 + 35
    assert may_be_known(asked, filters.limit(0), key="k", bucket="b").isEmpty()
    null = spark.createDataFrame([(None, 0)], "k string, b int")
    assert build_filter(null, 1, key="k", bucket="b").isEmpty()


def test_filter_sizes_follow_the_keys():
    sizes = [block_count(n, 64) for n in (0, 1, 65_536, 65_537, 10**9)]
    assert sizes == [1, 1, 1, 2, 16_384]


def test_filters_of_a_batch_cover_all_before_it_once():
    for batch in range(0, 700, 7):
        covered = []
        for level, group in current_filters(batch):
            covered += range(group * 8**level, (group + 1) * 8**level)
        assert covered == list(range(batch))
        assert len(current_filters(batch)) <= 7 * 4


def stored(spark, store):
    return sorted(int(r["native_id"]) for r in read_transactions(spark, store.transactions).collect())


def test_a_new_key_reads_no_index_file(spark, tmp_path, monkeypatch):
    """Six batches of new keys over three levels, each also replayed; then old keys again."""
    monkeypatch.setattr(keyed, "FAN_IN", 2)
    read, real = [], keyed.read_keys

    def counted(*args):
        found = real(*args)
        read.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(keyed, "read_keys", counted)
    store = Store(str(tmp_path / "store"), 4)
    keyed.load_history(txns(spark, [("bank-a", str(i), 5, i) for i in range(100, 130)]), store)
    for k in range(6):
        rows = txns(spark, [("bank-a", str(i), 5, i) for i in range(10 * k, 10 * k + 10)])
        for _ in range(2 if k in (1, 3) else 1):
            remember(store_new(rows, k, store), k, store)
    assert read == [] and stored(spark, store) == [*range(60), *range(100, 130)]
    # Batches 0 to 3 have one filter, 4 and 5 another; those they replace are gone.
    assert current_filters(6) == [(2, 0), (1, 2)]
    levels = {p.relative_to(tmp_path / "store" / "key_filters").as_posix() for p in (tmp_path / "store" / "key_filters").glob("*/batch_id=*")}
    assert levels >= {"level-2/batch_id=0", "level-1/batch_id=2", "level-0/batch_id=-1"}
    assert "level-0/batch_id=0" not in levels and "level-1/batch_id=0" not in levels

    again = txns(spark, [("bank-a", str(i), 5, i) for i in (3, 57, 58, 105, 200, 201)])
    remember(store_new(again, 6, store), 6, store)
    assert stored(spark, store) == [*range(60), *range(100, 130), 200, 201]
    # Four known keys: at most their buckets are read, of seven batches each.
    assert len(read) == 1 and 0 < read[0] <= 4 * 7


def test_keys_without_filters_are_refused(spark, tmp_path):
    from riskweave.session import delete_folder

    store = Store(str(tmp_path / "store"), 2)
    batch = to_envelope(txns(spark, [("bank-a", "1", 5, 0)]))
    ingest_batch(batch, 0, store, clock(0))
    delete_folder(spark, f"{store.key_filters}/level-0/batch_id=0")
    with pytest.raises(RuntimeError, match="makes the filter"):
        ingest_batch(batch, 1, store, clock(1))


def test_no_row_is_too_late_for_the_exact_stream(spark, tmp_path):
    """Copies and new rows that come far behind the stream's time."""
    source, store = str(tmp_path / "in"), Store(str(tmp_path / "store"), 2)
    for part in (range(500_000, 500_020), [*range(10), *range(500_000, 500_005)], [3, 500_003, 11]):
        rows = txns(spark, [("bank-a", str(i), 5, i) for i in part])
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(dedupe_stream(stream, store))
    assert stored(spark, store) == [*range(10), 11, *range(500_000, 500_020)]
    assert dedupe_first(read_transactions(spark, store.transactions), "occurred_at").count() == 31
