from __future__ import annotations

import pytest
from conftest import RULE_SCHEMA, frame, txn
from pyspark.sql import functions as F
from test_rules import random_rows

import brute
from riskweave.constants import FEATURE_COLUMNS
from riskweave.functions.times import hour_of_day, rfc3339_text, weekday
from riskweave.operators.features import build_features
from riskweave.operators.flags import with_rule_flag_count

SCHEMA = RULE_SCHEMA + ", rule_flag_count int"


def built(spark, rows, **kw):
    df = frame(spark, [(*r, 0) for r in rows], SCHEMA)
    return {r["idempotency_key"]: r for r in build_features(df, **kw).collect()}


def test_all_columns(spark):
    df = frame(spark, [(*txn("a"), 0)], SCHEMA)
    assert set(FEATURE_COLUMNS) <= set(build_features(df).columns)


def test_velocity_looks_back_from_each_row(spark):
    """Times in seconds and, for each, how many of the others lie at most 120 before it."""
    times = {"a": 0, "b": 119, "c": 120, "d": 121, "e": 241, "f": 900}
    want = {k: sum(0 <= t - u <= 120 for j, u in times.items() if j != k) for k, t in times.items()}
    got = built(spark, [txn(k, "holder", seconds=s) for k, s in times.items()])
    assert {k: got[k]["velocity_count"] for k in times} == want


@pytest.mark.parametrize("high", ["6051", "7995"])
def test_categories(spark, high):
    used = ["6051", "7995", "6051", "1234", "7995"]
    rows = [txn(f"r{i}", "holder", category=c, seconds=i * 1000) for i, c in enumerate(used)]
    got = built(spark, rows, high_risk_category=high)
    assert [got[f"r{i}"]["category_seen_before"] for i in range(5)] == [0, 0, 1, 0, 1]
    assert [got[f"r{i}"]["is_high_risk_mcc"] for i in range(5)] == [int(c == high) for c in used]


@pytest.mark.parametrize("seconds", [0.25, 90.0, 86_400.0])
def test_speed_uses_the_fraction_of_a_second(spark, seconds):
    rows = [txn("a", "holder", city="Denver"), txn("b", "holder", city="Boston", seconds=seconds)]
    got = built(spark, rows)
    km = brute.km_between("Denver", "Boston")
    assert got["a"]["geo_speed_kmh"] == 0.0
    assert got["b"]["geo_speed_kmh"] == pytest.approx(km / (seconds / 3600))


def test_speed_without_time_or_distance(spark):
    rows = [
        txn("a", "x", city="Miami"),
        txn("b", "x", city="London"),
        txn("c", "x", city="London", seconds=60),
        txn("d", "y", city="Seattle", seconds=61),
        txn("e", "x", city="Nowhere", seconds=62),
    ]
    got = built(spark, rows)
    assert got["b"]["geo_speed_kmh"] == pytest.approx(brute.km_between("Miami", "London") * 1e6)
    assert [got[k]["geo_speed_kmh"] for k in "acde"] == [0.0] * 4


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session(spark, zone):
    """Midnight UTC, the hour that New York skips, and an instant before the epoch."""
    us = [1_704_067_200_000_000, 1_710_055_800_250_000, -1_500_000]
    df = spark.createDataFrame([(u,) for u in us], "us bigint").select(
        "us", F.timestamp_micros("us").alias("t")
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = df.select(
            rfc3339_text(F.col("t")).alias("text"),
            hour_of_day(F.col("us")).alias("hour"),
            weekday(F.col("us")).alias("day"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in rows] == [
        ("2024-01-01T00:00:00Z", 0, 0),
        ("2024-03-10T07:30:00.25Z", 7, 6),
        ("1969-12-31T23:59:58.5Z", 23, 2),
    ]


def test_whole_seconds_unlike_the_rule(spark):
    got = built(spark, [txn("a", seconds=0.0), txn("b", seconds=120.9)])
    assert got["b"]["velocity_count"] == 1


def test_hour_and_weekday_are_utc(spark):
    got = built(spark, [txn("a")])  # Thursday 2026-01-01 09:00
    assert (got["a"]["hour_of_day"], got["a"]["weekday"]) == (9, 3)


@pytest.mark.parametrize(
    "route", [{}, {"heavy_rows": 0, "chunk_rows": 30}], ids=["whole", "cut"]
)
def test_random_rows_equal_definition(spark, route):
    rows = random_rows(700, 5)
    got = built(spark, rows, **route)
    want = brute.features(rows)
    assert set(got) == set(want)
    for key, (velocity, seen, speed) in want.items():
        row = got[key]
        assert (row["velocity_count"], row["category_seen_before"]) == (velocity, seen), key
        assert row["geo_speed_kmh"] == pytest.approx(speed, rel=1e-9)


def test_rule_flag_count(spark):
    txns = frame(spark, [txn("a"), txn("b"), txn("c"), txn("d")])
    flags = spark.createDataFrame(
        [("a", "x\ny"), ("b", ""), ("c", "x")], "idempotency_key string, reasons string"
    )
    got = {
        r["idempotency_key"]: r["rule_flag_count"]
        for r in with_rule_flag_count(txns, flags).collect()
    }
    assert got == {"a": 2, "b": 1, "c": 1, "d": 0}


def test_two_sorts_and_one_shuffle(spark):
    df = frame(spark, [(*txn("a"), 0)], SCHEMA)
    plan = build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort ") == 2


@pytest.mark.parametrize(
    "route", [{}, {"heavy_rows": 0, "chunk_rows": 30}], ids=["whole", "cut"]
)
def test_features_since_a_time_equal_those_of_a_full_pass(spark, route):
    rows = random_rows(500, 31)
    start = {a: int(txn(seconds=s)[5].timestamp()) * 1_000_000 + 1 for a, s in
             (("", 1200.0), ("acct-1", 30.0), ("acct-2", 2500.0))}
    since = spark.createDataFrame(list(start.items()), "account_id string, since_us bigint")
    full, part = built(spark, rows), built(spark, rows, since=since, **route)
    kept = {
        r[0]
        for r in rows
        if r[1] in start and round(r[5].timestamp() * 1_000_000) >= start[r[1]]
    }
    assert set(part) == kept and part
    for key, row in part.items():
        assert row["geo_speed_kmh"] == pytest.approx(full[key]["geo_speed_kmh"], rel=1e-9)
        assert row["velocity_count"] == full[key]["velocity_count"]
        assert row["category_seen_before"] == full[key]["category_seen_before"]
