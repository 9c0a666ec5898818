"""Streams end in the same tables as their batch twins."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import at
from pyspark.sql import functions as F
from test_ingest import txns

from riskweave.constants import RuleSettings
from riskweave.operators.flags import upsert_flags
from riskweave.operators.rules import score
from riskweave.schemas import DECISION, ENVELOPE, FLAG, QUARANTINE
from riskweave.sources.envelopes import to_envelope
from riskweave.sources.harness import event_transactions
from riskweave.sources.tables import (
    read_batches,
    read_keys,
    read_table,
    read_transactions,
    touched_buckets,
    write_transaction_batch,
)
from riskweave.streaming.ingest import (
    drop_recent_duplicates,
    ingest_batch,
    ingest_stream,
    read_message_files,
)
from riskweave.streaming.keys import load_history
from riskweave.streaming.score import (
    dashboard_snapshot,
    read_transaction_files,
    score_batch,
    score_stream,
)
from riskweave.streaming.store import (
    RETRY,
    TALLY,
    Store,
    current_flags,
    read_new_flags,
    record_decisions,
    stored_flags,
)

DAY = RuleSettings(window_seconds=86_400)


def clock(batch_id):
    return datetime(2026, 2, 1, tzinfo=timezone.utc) + timedelta(seconds=batch_id)


def drain(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def tally_of(spark, store):
    rows = read_batches(spark, store.tally, TALLY).groupBy("outcome").sum("n").collect()
    return {r["outcome"]: r["sum(n)"] for r in rows if r["sum(n)"]}


def test_ingest_stores_each_key_once(spark, tmp_path):
    source = str(tmp_path / "in")
    store = Store(str(tmp_path / "store"), 2)
    good = [("bank-a", str(i), 5, i) for i in range(30)]
    first = txns(spark, [*good[:20], ("bank-a", "bad", 0, 0)])
    second = txns(spark, good[10:])
    broken = spark.createDataFrame([("{bad", 0, "m")], "body string, retry_count int, message_id string")
    for part in (to_envelope(first).unionByName(to_envelope(first)), to_envelope(second).unionByName(broken)):
        part.coalesce(1).write.mode("append").json(source)
    drain(ingest_stream(read_message_files(spark, source, 1), store, clock))
    assert read_transactions(spark, store.transactions).count() == 30
    reasons = [r["reason"] for r in read_batches(spark, store.quarantine).collect()]
    assert sum(r.startswith("unmarshal error: ") for r in reasons) == 1
    assert sum("zero amount" in r for r in reasons) == 2
    tally = tally_of(spark, store)
    assert tally["accepted"] == 30 and tally["duplicate"] == 30

    # Starting again from the checkpoint, without new files, adds nothing.
    drain(ingest_stream(read_message_files(spark, source, 1), store, clock))
    assert read_transactions(spark, store.transactions).count() == 30


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = Store(str(tmp_path / "store"), 2)
    batch = to_envelope(txns(spark, [("bank-a", str(i), i % 3, i) for i in range(9)]))
    tables = []
    for _ in range(2):
        ingest_batch(batch, 0, store, clock(0))
        tables.append(
            (
                sorted(r["idempotency_key"] for r in read_transactions(spark, store.transactions).collect()),
                sorted(r["reason"] for r in read_batches(spark, store.quarantine).collect()),
                tally_of(spark, store),
            )
        )
    assert tables[0] == tables[1]
    assert tables[0][2] == {"accepted": 6, "invalid": 3}


def test_replay_from_every_point_of_failure(spark, tmp_path, monkeypatch):
    """The batch dies before each of its writes in turn and is repeated each time."""
    from riskweave.streaming import ingest, keys

    store = Store(str(tmp_path / "store"), 2)
    load_history(txns(spark, [("bank-a", "0", 5, 0)]), store)
    batch = to_envelope(txns(spark, [("bank-a", str(i), i % 3, i) for i in range(1, 9)] * 2))
    steps = {
        "write_batch": ingest,
        "write_transaction_batch": keys,
        "write_key_batch": keys,
        "write_filters": keys,
    }
    for step, module in steps.items():
        for fail_at in (1, 2, 3) if step == "write_batch" else (1,):
            calls = []
            real = getattr(module, step)

            def dies(*args, calls=calls, real=real, fail_at=fail_at, **kw):
                calls.append(1)
                if len(calls) == fail_at:
                    raise RuntimeError("executor lost")
                return real(*args, **kw)

            monkeypatch.setattr(module, step, dies)
            with pytest.raises(RuntimeError):
                ingest_batch(batch, 0, store, clock(0))
            monkeypatch.undo()
    for batch_id in (0, 0, 1):
        ingest_batch(batch, batch_id, store, clock(batch_id))
    stored = [r["native_id"] for r in read_transactions(spark, store.transactions).collect()]
    assert sorted(stored) == ["0", "1", "2", "4", "5", "7", "8"]
    assert tally_of(spark, store) == {"accepted": 6, "duplicate": 6 + 12, "invalid": 8}


def test_duplicate_check_reads_only_touched_key_buckets(spark, tmp_path):
    store = Store(str(tmp_path / "store"), 16)
    load_history(txns(spark, [("bank-a", str(i), 5, i) for i in range(200)]), store)
    one = txns(spark, [("bank-a", "7", 5, 7)])
    buckets = touched_buckets(one, "idempotency_key", store.buckets)
    known = read_keys(spark, store.keys, buckets, 0)
    assert 1 <= known.count() < 60
    assert "PartitionFilters: [isnotnull(" in known._jdf.queryExecution().executedPlan().toString()
    assert read_keys(spark, store.keys, buckets, -1).isEmpty()


def test_failed_deliveries_retry_then_die(spark, tmp_path):
    store = Store(str(tmp_path / "store"), 2)
    start = datetime(2026, 2, 1, tzinfo=timezone.utc)

    def handler():
        return F.when(F.col("native_id").endswith("9999"), F.lit("poison"))

    first = to_envelope(txns(spark, [("bank-a", "9999", 5, 0), ("bank-a", "1", 5, 0)]))
    empty = first.limit(0)
    ingest_batch(first, 0, store, start, handler)
    assert read_transactions(spark, store.transactions).count() == 1
    # One second later the retry is not due yet; it must still be waiting afterwards.
    ingest_batch(empty, 1, store, start + timedelta(seconds=1), handler)
    assert read_batches(spark, store.retries, RETRY, 1).first()["retry_count"] == 1
    for n in range(2, 6):
        ingest_batch(empty, n, store, start + timedelta(seconds=10 * n), handler)
    dead = read_batches(spark, store.quarantine, QUARANTINE).collect()
    assert [r["reason"] for r in dead] == ["gave up after 3 retries: poison"]
    assert read_batches(spark, store.retries, RETRY, 5).isEmpty()
    tally = tally_of(spark, store)
    assert (tally["retry"], tally["dead"], tally["accepted"]) == (3, 1, 1)


def test_transient_failure_heals(spark, tmp_path):
    store = Store(str(tmp_path / "store"), 2)
    start = datetime(2026, 2, 1, tzinfo=timezone.utc)
    batch = to_envelope(txns(spark, [("bank-a", str(i), 5, i) for i in range(4)]))
    ingest_batch(batch, 0, store, start, lambda: F.lit("busy"))
    assert read_transactions(spark, store.transactions).isEmpty()
    ingest_batch(batch.limit(0), 1, store, start + timedelta(seconds=5))
    assert read_transactions(spark, store.transactions).count() == 4


def test_scoring_in_micro_batches_equals_one_pass(spark, sf_dir, tmp_path):
    store = Store(str(tmp_path / "store"), 4)
    txn_rows = event_transactions(spark, sf_dir)
    days = F.dayofmonth("occurred_at")
    for batch_id, (lo, hi) in enumerate(((1, 10), (11, 20), (21, 31))):
        part = txn_rows.filter(days.between(lo, hi))
        write_transaction_batch(part, store.transactions, batch_id, store.buckets)
        score_batch(part, batch_id, store, clock(batch_id), DAY)
    want = {r["idempotency_key"]: r["reasons"] for r in score(txn_rows, DAY).collect()}
    got = {r["idempotency_key"]: r["reasons"] for r in stored_flags(spark, store).collect()}
    assert got == want
    feed = [r["idempotency_key"] for r in read_new_flags(spark, store).collect()]
    assert sorted(feed) == sorted(want)

    # A replay of the last batch neither changes the flags nor repeats the feed.
    score_batch(txn_rows.filter(days.between(21, 31)), 2, store, clock(2), DAY)
    again = {r["idempotency_key"]: r["reasons"] for r in stored_flags(spark, store).collect()}
    assert again == want
    assert len(read_new_flags(spark, store).collect()) == len(feed)


def test_late_rows_equal_rescan_and_upsert(spark, sf_dir, tmp_path):
    """Shuffled arrival: flags are never retracted, exactly as with full rescans."""
    store = Store(str(tmp_path / "store"), 4)
    txn_rows = event_transactions(spark, sf_dir)
    part_of = F.pmod(F.xxhash64("idempotency_key"), F.lit(3))
    rescan = spark.createDataFrame([], FLAG)
    for batch_id in range(3):
        part = txn_rows.filter(part_of == batch_id)
        write_transaction_batch(part, store.transactions, batch_id, store.buckets)
        score_batch(part, batch_id, store, clock(batch_id), DAY)
        so_far = txn_rows.filter(part_of <= batch_id)
        now = F.lit(clock(batch_id)).cast("timestamp")
        rescan = upsert_flags(rescan, score(so_far, DAY), now).checkpoint()
        # A replay of the batch before goes by without a trace.
        score_batch(part, batch_id, store, clock(batch_id + 100), DAY)
    columns = ["idempotency_key", "reasons", "created_at", "status"]
    got = sorted(tuple(r) for r in stored_flags(spark, store).select(*columns).collect())
    assert got == sorted(tuple(r) for r in rescan.select(*columns).collect())


def test_score_stream_and_review(spark, sf_dir, tmp_path):
    store = Store(str(tmp_path / "store"), 4)
    txn_rows = event_transactions(spark, sf_dir)
    load_history(txn_rows, store)
    source = read_transaction_files(spark, store.transactions, 2)
    drain(score_stream(source, store, clock, DAY))
    flags = current_flags(spark, store)
    want = {r["idempotency_key"] for r in score(txn_rows, DAY).collect()}
    assert {r["idempotency_key"] for r in flags.collect()} == want

    one = sorted(want)[0]
    decision = spark.createDataFrame([(one, "approved", at(0))], DECISION)
    record_decisions(decision, store)
    snapshot = dashboard_snapshot(txn_rows, current_flags(spark, store))
    assert one not in {r["idempotency_key"] for r in snapshot["queue"].collect()}
    counts = {r["status"]: r["n"] for r in snapshot["counts"].collect()}
    assert counts == {"pending": len(want) - 1, "approved": 1, "denied": 0}
    assert snapshot["metrics"].count() == 1
    no_attacks = txn_rows.filter(F.col("bank") != "attack-sim")
    assert dashboard_snapshot(no_attacks, flags)["metrics"].isEmpty()


def test_duplicate_filter(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = txns(spark, [("bank-a", str(i), 5, i) for i in range(20)])
    for _ in range(3):
        rows.write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    drain(
        drop_recent_duplicates(stream, "occurred_at", "1 hour")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "progress"))
    )
    assert spark.read.parquet(out).count() == 20


def test_stateful_rules_equal_the_batch_rules(spark, tmp_path):
    """Rows come out of order but within the delay; a last row far ahead moves the watermark."""
    from conftest import frame, txn
    from test_rules import random_rows

    import brute
    from riskweave.streaming.stateful import rules_stateful

    rows = [
        r if r[1] != "" else (r[0], "acct-hot", *r[2:]) for r in random_rows(300, 11)
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    far = [txn("zzz", "nobody", seconds=10 * 86400)]
    for part in (rows[::3], rows[1::3], rows[2::3], far):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema(frame(spark, far).schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(source)
    )
    heavy = spark.createDataFrame([("acct-3",)], "account_id string")
    drain(
        rules_stateful(stream, 7200, heavy_accounts=heavy)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "progress"))
    )
    got = {r["idempotency_key"]: r["reasons"] for r in spark.read.parquet(out).collect()}
    assert got == brute.flags([r for r in rows if r[1] != "acct-3"])
    assert got != brute.flags(rows)


def test_retry_comes_in_time_without_new_messages(spark, tmp_path):
    """A failed delivery waits in the state of the retry stream; another one waits on."""
    import time

    from riskweave.streaming.retry import read_due, read_failures, retry_stream

    store = Store(str(tmp_path / "store"), 2)
    due_at = datetime.now(timezone.utc) + timedelta(seconds=20)
    far = due_at + timedelta(days=1)
    batch = to_envelope(txns(spark, [("bank-a", "1", 5, 0), ("bank-a", "2", 5, 0)]))
    for k, (part, when) in enumerate(((batch.filter("message_id like '%:1'"), due_at), (batch.filter("message_id like '%:2'"), far))):
        ingest_batch(part, k, store, when - timedelta(seconds=2), lambda: F.lit("busy"), timers=True)
    assert read_transactions(spark, store.transactions).isEmpty()
    running = retry_stream(read_failures(spark, store), store).trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline and running.exception() is None:
            found = read_table(spark, store.due, ENVELOPE)
            if not found.isEmpty():
                break
            time.sleep(1)
    finally:
        running.stop()
    assert datetime.now(timezone.utc) >= due_at
    assert [(r.message_id, r.retry_count) for r in found.collect()] == [("bank-a:1", 1)]
    again = batch.filter("message_id like '%:1'").withColumn("retry_count", F.lit(1))
    ingest_batch(again, 2, store, far, timers=True)
    assert read_transactions(spark, store.transactions).count() == 1
    assert read_due(spark, store).isStreaming


def test_the_flags_of_a_batch_are_written_once_before_scoring(spark, tmp_path, monkeypatch):
    """Scoring reads them several times, and the log they come from is read for each."""
    from riskweave.streaming import score as module
    from riskweave.streaming.store import read_scores

    rows = [(k, "a", 1, "c", "r", at(0), "pending", None, at(0), at(0)) for k in ("x", "y")]
    flags, given = spark.createDataFrame(rows, FLAG), []

    def scored(mine, history, model, settings=None):
        given.extend(mine.inputFiles())
        return mine.withColumn("ml_score", F.lit(0.5))

    monkeypatch.setattr(module, "stored_flags", lambda *_: flags)
    monkeypatch.setattr(module, "score_pending", scored)
    store = Store(str(tmp_path), 2)
    module.score_pending_batch(flags.filter("idempotency_key = 'x'"), 0, store, None)
    assert given and all("/named-flags-" in path for path in given)
    assert [tuple(r) for r in read_scores(spark, store).collect()] == [("x", 0.5)]


def test_every_core_writes_a_part_of_what_is_served(spark, tmp_path, monkeypatch):
    """Seven writes of stream_dedupe, each in as many files as there are cores, not in four."""
    from glob import glob

    from riskweave.plans import queries as module

    paths, make = {}, module.scratch_path

    def made(session, name):
        return paths.setdefault(name, make(session, name))

    monkeypatch.setattr(module, "scratch_path", made)
    event = (
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 600) AS ts",
        "id % 9 AS user_id", "'view' AS event_type", "id / 4D AS value", "'{\"k\": 7}' AS props",
    )
    spark.range(4000).selectExpr(*event).write.parquet(f"{tmp_path}/events.parquet")
    assert module.QUERIES["stream_dedupe"](spark, str(tmp_path)).count() == 4000
    folder = paths["served"].removeprefix("file:")
    assert len(glob(f"{folder}/*.parquet")) == 7 * spark.sparkContext.defaultParallelism > 28


def test_state_calls_of_retries_follow_groups_not_messages():
    """Rows of a group that are due together are one entry with one timer, in bounded parts."""
    from types import SimpleNamespace

    import pandas as pd

    from riskweave.streaming import retry as module

    kept, timers = {}, []
    state = SimpleNamespace(
        updateValue=kept.__setitem__, keys=lambda: iter(list(kept)), getValue=kept.__getitem__, removeKey=kept.pop
    )
    held = module.RetryTimers()
    held.init(SimpleNamespace(getMapState=lambda *_: state, registerTimer=timers.append))
    rows = pd.DataFrame(
        {
            "body": [None, *(f"b{k}" for k in range(998)), "x" * (3 << 20)],
            "retry_count": [k % 3 for k in range(1000)],
            "message_id": [None if k % 5 == 0 else f"m{k}" for k in range(1000)],
            "due": [1_000 + k % 2 for k in range(1000)],
        }
    ).astype({"retry_count": "int32"})
    for part in (rows[:400], rows[400:]):
        list(held.handleInputRows((0,), iter([part]), None))
    assert len(kept) == len(timers) == 5 and set(timers) == {1_000, 1_001}

    def due(now):
        clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        found = pd.concat(held.handleExpiredTimer((0,), clock, None))
        return [] if found.empty else sorted(map(str, found[module.COLUMNS].itertuples(index=False, name=None)))

    def want(own):
        own = own.astype(object).where(own.notna(), None)
        return sorted(map(str, own[module.COLUMNS].itertuples(index=False, name=None)))

    assert due(999) == [] and due(1_000) == want(rows[rows["due"] == 1_000])
    assert due(1_000) == [] and due(5_000) == want(rows[rows["due"] == 1_001]) and not kept
