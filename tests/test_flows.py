"""Whole flows: feeds and an attack burst, from native records to the review page."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import T0
from pyspark.sql import functions as F

from riskweave.constants import CITIES, FEATURE_COLUMNS
from riskweave.functions import dollars_to_cents, micros, parse_rfc3339, rfc3339_text
from riskweave.operators.evaluate import evaluate, report
from riskweave.operators.features import build_features, with_label
from riskweave.operators.flags import review_queue, with_rule_flag_count
from riskweave.operators.model import train_and_evaluate
from riskweave.plans.batch import feeds_to_transactions, rescore
from riskweave.schemas import FLAG, TXN
from riskweave.sources.envelopes import to_envelope
from riskweave.sources.feeds import FEEDS, parse_records
from riskweave.sources.tables import read_batches, read_transactions
from riskweave.streaming.ingest import ingest_batch
from riskweave.streaming.score import dashboard_snapshot, score_batch
from riskweave.streaming.store import Store, current_flags

AS_OF = datetime(2026, 3, 1, tzinfo=timezone.utc)
CATEGORIES = ("5814", "4111", "7372", "5411")


def native_rows(bank, days=12, per_day=12, accounts=10):
    """Quiet customers: each stays in one city and shops hours apart."""
    rng = random.Random(bank)
    feed = FEEDS[bank]
    for day in range(days):
        for n in range(per_day):
            account = rng.randrange(accounts)
            when = T0 + timedelta(days=day, minutes=110 * n + rng.randrange(100))
            amount = 500 + rng.randrange(5000)
            yield {
                feed.native_id: f"{bank}-{day:02d}-{n:02d}",
                feed.account_id: f"{bank}-acct-{account}",
                feed.amount: amount / 100 if feed.amount_in_dollars else amount,
                feed.merchant_name: "Shop",
                feed.merchant_category: rng.choice(CATEGORIES[:1]),
                feed.city: CITIES[account][0],
                feed.occurred_at: when.strftime("%Y-%m-%dT%H:%M:%SZ"),
            }


@pytest.fixture(scope="module")
def natives(spark):
    return {
        bank: parse_records(
            spark.createDataFrame([(json.dumps(r),) for r in native_rows(bank)], "body string"),
            feed,
        )
        for bank, feed in FEEDS.items()
    }


def attack(n=20):
    """A burst on a fresh account, published straight as messages."""
    start = T0 + timedelta(days=13)
    return [
        json.dumps(
            {
                "bank": "attack-sim",
                "native_id": f"a{i:02d}",
                "account_id": "acct-demo",
                "amount_cents": 4999,
                "currency": "USD",
                "merchant_name": "Casino",
                "merchant_category": "7995",
                "city": "Chicago",
                "timestamp": (start + timedelta(milliseconds=300 * i)).isoformat(),
            }
        )
        for i in range(n)
    ]


def messages(spark, bodies):
    rows = [(b, 0, f"attack-sim:{json.loads(b)['native_id']}") for b in bodies]
    return spark.createDataFrame(rows, "body string, retry_count int, message_id string")


def test_attack_on_a_live_store(spark, natives, tmp_path):
    store = Store(str(tmp_path / "store"), 4)
    as_of = F.lit(AS_OF).cast("timestamp")
    empty = spark.createDataFrame([], TXN)
    clean, quarantined = feeds_to_transactions(natives, empty, as_of=as_of, rounding="half_up")
    assert quarantined.isEmpty() and clean.count() == 3 * 12 * 12

    ingest_batch(to_envelope(clean), 0, store, AS_OF)
    ingest_batch(messages(spark, attack() + attack()), 1, store, AS_OF)
    stored = read_transactions(spark, store.transactions)
    assert stored.count() == 3 * 12 * 12 + 20
    assert read_batches(spark, store.quarantine).isEmpty()

    for batch_id, part in enumerate(
        (stored.filter("bank <> 'attack-sim'"), stored.filter("bank = 'attack-sim'"))
    ):
        score_batch(part, batch_id, store, AS_OF)
    flags = current_flags(spark, store)
    caught = flags.filter(F.col("idempotency_key").startswith("attack-sim:"))
    # The first four rows of a burst are too few to be one.
    assert caught.count() == 16
    row = evaluate(stored, flags).first()
    assert (row["attack_transactions"], row["attack_flagged"], row["recall"]) == (20, 16, 0.8)
    assert report(evaluate(stored, flags)).first()["recall"] == "80.0%"

    page = dashboard_snapshot(stored, flags)
    assert page["metrics"].count() == 1
    newest = [r["idempotency_key"] for r in page["queue"].limit(3).collect()]
    assert newest == ["attack-sim:a19", "attack-sim:a18", "attack-sim:a17"]
    # The batch flow over the same table ends in the same flags.
    batch = rescore(stored, spark.createDataFrame([], FLAG), as_of=as_of)
    assert {tuple(r) for r in batch.select("idempotency_key", "reasons").collect()} == {
        tuple(r) for r in flags.select("idempotency_key", "reasons").collect()
    }

    labelled = with_rule_flag_count(with_label(stored), flags)
    metrics = train_and_evaluate(labelled, trees=5).metrics.first()
    assert metrics["train_size"] + metrics["test_size"] == 452
    assert metrics["test_attack_count"] == 4
    assert metrics["precision"] == metrics["recall"] == metrics["auc"] == 1.0


def test_training_and_scoring_share_their_features(spark, natives):
    as_of = F.lit(AS_OF).cast("timestamp")
    clean, _ = feeds_to_transactions(natives, spark.createDataFrame([], TXN), as_of=as_of)
    rows = clean.withColumn("rule_flag_count", F.lit(0))
    plain = build_features(rows)
    labelled = build_features(with_label(rows))
    columns = ["idempotency_key", *FEATURE_COLUMNS]
    assert sorted(plain.select(*columns).collect()) == sorted(labelled.select(*columns).collect())


def test_truncation_loses_a_cent_on_a_known_share(spark):
    cents = spark.range(500, 20_500).select("id", (F.col("id") / 100.0).alias("d"))
    lost = cents.select((F.col("id") - dollars_to_cents(F.col("d"))).alias("lost"))
    assert {r["lost"]: r["count"] for r in lost.groupBy("lost").count().collect()} == {
        0: 18_889,
        1: 1_111,
    }


def test_rfc3339_against_python(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(500):
        offset = timezone(timedelta(minutes=rng.randrange(-17 * 60, 17 * 60)))
        when = datetime(1990, 1, 1, tzinfo=offset) + timedelta(
            seconds=rng.randrange(2_000_000_000), microseconds=rng.choice([0, rng.randrange(10**6)])
        )
        us = round(when.timestamp()) if when.microsecond == 0 else None
        whole = int((when - timedelta(microseconds=when.microsecond)).timestamp())
        rows.append((when.isoformat(), whole * 1_000_000 + when.microsecond))
        assert us is None or us == whole
    df = spark.createDataFrame(rows, "text string, us bigint")
    parsed = parse_rfc3339(F.col("text"))
    assert df.filter(~micros(parsed).eqNullSafe(F.col("us"))).isEmpty()
    again = micros(parse_rfc3339(rfc3339_text(parsed)))
    assert df.filter(~again.eqNullSafe(F.col("us"))).isEmpty()


def test_plans_prune_and_push(spark, sf_dir):
    from riskweave.plans import inputs
    from riskweave.plans.queries import QUERIES

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    scored = plan(QUERIES["score_rules"](spark, sf_dir))
    schema = scored.split("ReadSchema: ")[1].split("\n")[0]
    assert "event_type" in schema and scored.count("Exchange hashpartitioning") == 1
    totals = plan(QUERIES["attack_totals"](spark, sf_dir))
    assert totals.split("ReadSchema: ")[1].split("\n")[0].strip() == "struct<event_type:string>"
    page = plan(review_queue(inputs.flag_table(spark, sf_dir), "denied", 25))
    assert "TakeOrderedAndProject" in page
