"""Sums kept beside streams: day histograms and the numbers of the review page."""

from __future__ import annotations

import random
from datetime import timedelta

import pandas as pd
import pytest
from conftest import T0
from pyspark.sql import functions as F
from test_stateful import Handle

from riskweave.operators.split import (
    day_histogram,
    split_boundaries,
    stored_split_boundaries,
)
from riskweave.streaming import sums
from riskweave.streaming.changes import CHANGES, MEASURES, StatusChanges, current_metrics, current_numbers
from riskweave.streaming.store import Store
from riskweave.streaming.sums import add_sums, next_batch, read_sums


def summed(df):
    return df.groupBy("measure").agg(F.sum("n").alias("n"))


def test_sums_over_generations_and_replays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sums, "GENERATION", 2)
    path = str(tmp_path / "sums")
    for batch in range(6):
        own = spark.createDataFrame([("a", batch), ("b", -1)], CHANGES).coalesce(1)
        for _ in range(2 if batch in (2, 5) else 1):
            add_sums(own, batch, path, summed)
        stacked = read_sums(spark, path, CHANGES, batch + 1)
        assert {r.measure: r.n for r in summed(stacked).collect()} == {"a": sum(range(batch + 1)), "b": -batch - 1}
        assert stacked.count() <= 4 and next_batch(spark, path) == batch + 1
    assert [p.name for p in sorted((tmp_path / "sums").glob("generation=*"))] == ["generation=2"]
    with pytest.raises(RuntimeError, match="is missing"):
        read_sums(spark, str(tmp_path / "none"), CHANGES, 3)
    assert read_sums(spark, str(tmp_path / "none"), CHANGES, 0).isEmpty() and next_batch(spark, str(tmp_path / "none")) == 0


def labelled(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (f"k{i}", float(rng.random() < 0.2), T0 + timedelta(hours=rng.randrange(600), seconds=rng.randrange(3)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "idempotency_key string, label double, occurred_at timestamp")


@pytest.mark.parametrize("limits", [{}, {"heavy_rows": 3, "chunk_rows": 4}])
def test_boundaries_from_stored_days(spark, limits):
    for n, seed in ((1, 1), (2, 2), (400, 3)):
        parts = [labelled(spark, n, seed + 10 * k).withColumn("idempotency_key", F.concat(F.lit(f"{k}-"), "idempotency_key")) for k in range(2)]
        both = parts[0].unionByName(parts[1])
        stacked = day_histogram(parts[0]).unionByName(day_histogram(parts[1]))
        want = {r.label: r.last_train for r in split_boundaries(both).collect()}
        assert {r.label: r.last_train for r in stored_split_boundaries(both, stacked, **limits).collect()} == want
    none = both.limit(0)
    assert stored_split_boundaries(none, day_histogram(none)).collect() == []


def test_only_the_boundary_days_are_read(spark, tmp_path, monkeypatch):
    from riskweave.operators import split

    path = str(tmp_path / "rows")
    labelled(spark, 300, 4).write.parquet(path)
    rows = spark.read.parquet(path)
    seen, real = [], split.boundaries_in
    monkeypatch.setattr(split, "boundaries_in", lambda txns, *a, **kw: (seen.append(txns), real(txns, *a, **kw))[1])
    stored_split_boundaries(rows, day_histogram(rows)).collect()
    days = {r.occurred_at.date() for r in seen[0].collect()}
    assert len(days) <= 2
    assert "GreaterThanOrEqual(occurred_at" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_changes_add_up_to_the_status_in_any_order():
    rng = random.Random(5)
    for _ in range(200):
        events = [(True, None, None)] * rng.choice([0, 1, 1, 2])
        events += [(False, rng.randrange(5), rng.choice(["approved", "denied"])) for _ in range(rng.randrange(4))]
        rng.shuffle(events)
        processor = StatusChanges()
        processor.init(Handle())
        total, given = {}, list(events)
        while events:
            batch, events = events[:2], events[2:]
            chunk = pd.DataFrame(batch, columns=["is_flag", "decided_us", "decision"])
            for out in processor.handleInputRows(("k",), iter([chunk]), None):
                for measure, n in out.itertuples(index=False):
                    total[measure] = total.get(measure, 0) + n
        flagged = any(e[0] for e in given)
        decided = [(e[1], e[2]) for e in given if not e[0]]
        want = {(max(decided)[1] if decided else "pending"): 1} if flagged else {}
        assert {m: n for m, n in total.items() if n} == want


def test_a_group_of_keys_costs_one_read_and_one_write_of_the_state():
    rng, handle, total = random.Random(6), Handle(), {}
    processor = StatusChanges()
    processor.init(handle)
    keys = [None, *[f"k{k}" for k in range(30)]]
    events = [(k, True, None, None) for k in keys[:20]]
    events += [(k, False, rng.randrange(50), rng.choice(["approved", "denied"])) for k in keys for _ in range(3)]
    rng.shuffle(events)
    columns = ["idempotency_key", "is_flag", "decided_us", "decision"]
    for part in (events[:50], events[50:]):
        chunks = iter([pd.DataFrame(part[:20], columns=columns), pd.DataFrame(part[20:], columns=columns)])
        for out in processor.handleInputRows((7,), chunks, None):
            for measure, n in out.itertuples(index=False):
                total[measure] = total.get(measure, 0) + n
    want = {}
    for key in keys[:20]:
        status = max(e[2:] for e in events if e[0] == key and not e[1])[1]
        want[status] = want.get(status, 0) + 1
    assert {m: n for m, n in total.items() if n} == want
    assert handle.calls["update"] == 2 and handle.calls["get"] == 1


def test_numbers_of_an_empty_store(spark, tmp_path):
    store = Store(str(tmp_path / "store"), 2)
    assert [(r.measure, r.n) for r in current_numbers(spark, store).collect()] == [(m, 0) for m in MEASURES]
    row = current_metrics(spark, store).first()
    assert row["precision"] is None and row["attack_flagged"] == 0
