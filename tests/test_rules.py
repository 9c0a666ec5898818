"""Rule cases, and both scoring routes against the quadratic definition."""

from __future__ import annotations

import random

import pytest
from conftest import frame, txn

import brute
from riskweave.constants import RuleSettings
from riskweave.operators.history import with_history
from riskweave.operators.rules import RULES, score


def fired(df, **kw):
    return {r["idempotency_key"]: r["reasons"] for r in score(df, **kw).collect()}


# Both routes: whole accounts in one task, and every account cut into tiny chunks.
ROUTES = [
    pytest.param({}, id="whole"),
    pytest.param({"heavy_rows": 0, "chunk_rows": 3}, id="cut"),
]


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("threshold", [2, 3])
@pytest.mark.parametrize("gap, fires", [(30.0, True), (30.000001, False)])
def test_velocity_counts_a_closed_window(spark, route, threshold, gap, fires):
    """``threshold`` rows whose first and last are ``gap`` apart, under a window of 30 s."""
    rows = [txn(f"r{i}", "holder", seconds=100 + gap * i / (threshold - 1)) for i in range(threshold)]
    settings = RuleSettings(window_seconds=30, velocity_threshold=threshold)
    text = f"velocity: {threshold} transactions within 30s"
    want = {f"r{threshold - 1}": text} if fires else {}
    assert fired(frame(spark, rows), settings=settings, **route) == want


@pytest.mark.parametrize("route", ROUTES)
def test_peers_of_an_instant_count_by_key(spark, route):
    rows = [txn(key, "holder", seconds=7) for key in ("d", "b", "a", "c")]
    got = fired(frame(spark, rows), settings=RuleSettings(velocity_threshold=3), **route)
    assert got == {
        "c": "velocity: 3 transactions within 120s",
        "d": "velocity: 4 transactions within 120s",
    }


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("least", [1, 3])
def test_a_new_category_needs_history(spark, route, least):
    """Each row brings a category of its own, so exactly those past ``least`` rows fire."""
    rows = [txn(f"r{i}", "holder", category=f"c{i}", seconds=i * 5000) for i in range(5)]
    rows.append(txn("again", "holder", category="c0", seconds=90_000))
    got = fired(frame(spark, rows), settings=RuleSettings(min_history=least), **route)
    text = "mcc_drift: first time this account has used category c"
    assert got == {f"r{i}": f"{text}{i}" for i in range(least, 5)}


@pytest.mark.parametrize("route", ROUTES)
def test_travel_is_measured_from_the_row_before(spark, route):
    """Out and back: the hop home is as fast as the hop out, a stop in an unknown city hides both."""
    trip = [("Miami", 0), ("Seattle", 1800), ("Miami", 3600)]
    rows = [txn(f"r{i}", "holder", city=c, seconds=s) for i, (c, s) in enumerate(trip)]
    got = fired(frame(spark, rows), **route)
    assert set(got) == {"r1", "r2"}
    assert got["r1"].startswith("geo_impossible: Miami -> Seattle implies traveling ")
    kmh = int(got["r2"].split()[-2])
    assert kmh == round(brute.km_between("Seattle", "Miami") * 2)
    hidden = [txn(f"h{i}", "other", city=c, seconds=s) for i, (c, s) in enumerate([trip[0], ("Nowhere", 900), trip[1]])]
    assert fired(frame(spark, hidden), **route) == {}


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("margin, fires", [(0.99, True), (1.01, False)])
def test_speed_limit(spark, route, margin, fires):
    """As long as the fastest allowed trip takes, times ``margin``."""
    seconds = round(brute.km_between("Boston", "Denver") / RuleSettings().max_kmh * 3600 * margin)
    rows = [txn("a", "holder", city="Boston"), txn("b", "holder", city="Denver", seconds=seconds)]
    assert set(fired(frame(spark, rows), **route)) == ({"b"} if fires else set())


@pytest.mark.parametrize("route", ROUTES)
def test_no_time_between_cities(spark, route):
    """Less than a second apart counts as no time at all."""
    rows = [txn("a", "holder", city="Austin"), txn("b", "holder", city="London", seconds=0.4)]
    text = "geo_impossible: Austin -> London implies traveling instantaneously"
    assert fired(frame(spark, rows), **route) == {"b": text}


@pytest.mark.parametrize("route", ROUTES)
def test_reasons_keep_the_order_of_the_rules(spark, route):
    rows = [txn(f"r{i}", "holder", category="x", city="Tokyo", seconds=i) for i in range(6)]
    rows.append(txn("last", "holder", category="y", city="Boston", seconds=8))
    got = fired(frame(spark, rows), **route)["last"].split("\n")
    assert [r.split(":")[0] for r in got] == ["velocity", "mcc_drift", "geo_impossible"]


@pytest.mark.parametrize("route", ROUTES)
def test_rows_without_an_account_are_one_account(spark, route):
    rows = [txn(f"r{i}", None, seconds=i) for i in range(7)] + [txn(f"e{i}", "", seconds=i) for i in range(3)]
    got = fired(frame(spark, rows), **route)
    assert set(got) == {"r4", "r5", "r6"}
    since = spark.createDataFrame([(None, int(txn(seconds=5)[5].timestamp()) * 1_000_000)], "account_id string, since_us bigint")
    assert set(fired(frame(spark, rows), since=since, **route)) == {"r5", "r6"}


def test_repeated_keys_give_the_same_rows_by_both_routes(spark):
    rows = [txn(f"r{i}", "holder", category=str(i % 3), seconds=i) for i in range(8)] * 3
    df = frame(spark, rows)
    columns = ["idempotency_key", "position", "in_window", "first_use"]
    light = with_history(df, 120).select(*columns)
    heavy = with_history(df, 120, heavy_rows=0, chunk_rows=5).select(*columns)
    assert sorted(light.collect()) == sorted(heavy.collect())
    assert light.count() == 24


def random_rows(n, seed, hot_share=1 / 3):
    rng = random.Random(seed)
    cities = ["Chicago", "Tokyo", "London", "Atlantis", None, ""]
    rows = []
    for i in range(n):
        hot = rng.random() < hot_share
        account = "" if hot else f"acct-{rng.randrange(4)}"
        seconds = rng.randrange(0, 3000) + rng.choice([0, 0, 0.5, 0.25])
        rows.append(
            txn(
                f"k{i:05d}",
                account,
                100,
                str(rng.randrange(12)),
                rng.choice([seconds, 600, float(rng.randrange(60))]),
                rng.choice(cities),
            )
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "route",
    [{}, {"heavy_rows": 300, "chunk_rows": 60}, {"heavy_rows": 0, "chunk_rows": 25}],
    ids=["whole", "hot-cut", "all-cut"],
)
def test_random_rows_equal_definition(spark, seed, route):
    rows = random_rows(900, seed)
    assert fired(frame(spark, rows), **route) == brute.flags(rows)


def test_one_instant_holds_a_third(spark):
    """A burst at one microsecond: no time bucket could cut it, the key order does."""
    rows = [txn(f"b{i:04d}", "hot", category=str(i % 7)) for i in range(300)]
    rows += [txn(f"c{i:04d}", f"a{i % 50}", seconds=i) for i in range(600)]
    assert fired(frame(spark, rows), heavy_rows=100, chunk_rows=40) == brute.flags(rows)


def test_a_fourth_rule_can_be_added(spark):
    from pyspark.sql import functions as F

    def large(settings):
        return F.when(F.col("amount_cents") > 5000, F.lit("large: amount"))

    rows = [txn("k0", amount=100), txn("k1", amount=9000, seconds=10_000)]
    assert fired(frame(spark, rows), rules=(*RULES, large)) == {"k1": "large: amount"}


def test_thresholds_are_arguments(spark):
    rows = [txn("a", "holder", city="Miami"), txn("b", "holder", city="Austin", seconds=7200)]
    assert fired(frame(spark, rows)) == {}
    assert set(fired(frame(spark, rows), settings=RuleSettings(max_kmh=100.0))) == {"b"}
    assert fired(frame(spark, rows), settings=RuleSettings(max_kmh=100.0, min_km=9000.0)) == {}


@pytest.mark.parametrize("burst", [15, 20])
def test_burst_flags_all_but_four(spark, burst):
    rows = [txn(f"k{i:02d}", seconds=i * 0.3) for i in range(burst)]
    assert len(fired(frame(spark, rows))) == burst - 4


def test_one_shuffle_of_the_rows(spark):
    """Light accounts: one exchange on the account serves every window."""
    plan = score(frame(spark, [txn()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan




@pytest.mark.parametrize("route", [{}, {"heavy_rows": 0, "chunk_rows": 25}], ids=["whole", "cut"])
def test_judging_since_a_time_equals_the_tail_of_a_full_pass(spark, route):
    from pyspark.sql import functions as F

    rows = random_rows(600, 21)
    df = frame(spark, rows)
    cut = {"": 2000, "acct-0": 0, "acct-1": 1500, "acct-2": 2999}
    start = {a: int(txn(seconds=s)[5].timestamp()) * 1_000_000 for a, s in cut.items()}
    since = spark.createDataFrame(list(start.items()), "account_id string, since_us bigint")
    expected = brute.flags(rows)
    kept = {
        r[0]
        for r in rows
        if r[1] in start and round(r[5].timestamp() * 1_000_000) >= start[r[1]]
    }
    got = fired(df, since=since, **route)
    assert got == {k: v for k, v in expected.items() if k in kept}
    assert 0 < len(got) < len(expected)
    assert score(df, since=since.filter(F.lit(False))).isEmpty()
