"""Chronological split, training, scoring."""

from __future__ import annotations

import math
import shutil

import pytest
from conftest import at
from pyspark.sql import functions as F

from riskweave.operators.features import build_features
from riskweave.operators.model import (
    bounded_sample,
    held_out_metrics,
    load_model,
    middle_cuts,
    predict,
    rough_cuts,
    save_model,
    score_pending,
    train,
    train_and_evaluate,
    training_gate,
)
from riskweave.operators.split import chronological_split
from riskweave.plans.batch import train_and_rescore
from riskweave.schemas import FLAG

SCHEMA = (
    "idempotency_key string, account_id string, amount_cents bigint, merchant_category string, "
    "city string, occurred_at timestamp, rule_flag_count int, label double"
)


def ledger(spark, calm=250, raids=70):
    """Card holders who shop all day, and three mules who buy vouchers within an hour."""
    shops = [("5812", "London"), ("5942", "Paris"), ("5541", None)]
    rows = [
        (f"calm-{i}", f"holder-{i % 13}", 120 + 11 * (i * 37 % 211), *shops[i % 3], at(2820 * i), i % 2, 0.0)
        for i in range(calm)
    ]
    rows += [
        (f"raid-{i}", f"mule-{i % 3}", 90_000 - 17 * i, "6051", "Tokyo", at(3_456_000 + 11 * i), 1 + i % 2, 1.0)
        for i in range(raids)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def labelled(spark, times_by_label):
    rows = [
        (f"k{label}-{i:04d}", label, at(t))
        for label, times in times_by_label.items()
        for i, t in enumerate(times)
    ]
    return spark.createDataFrame(rows, "idempotency_key string, label double, occurred_at timestamp")


def split_of(df, **kw):
    got = {}
    for r in chronological_split(df, **kw).collect():
        got.setdefault((r["label"], r["split"]), set()).add(r["idempotency_key"])
    return got


@pytest.mark.parametrize("limits", [{}, {"heavy_rows": 0, "chunk_rows": 7}], ids=["rank", "cut"])
def test_split_sizes(spark, limits):
    df = labelled(spark, {0.0: [0], 1.0: [5, 1], 2.0: [9, 7, 5, 3, 1]})
    got = split_of(df, **limits)
    sizes = {k: len(v) for k, v in got.items()}
    assert sizes == {
        (0.0, "train"): 1,
        (1.0, "train"): 1,
        (1.0, "test"): 1,
        (2.0, "train"): 4,
        (2.0, "test"): 1,
    }
    assert got[(1.0, "test")] == {"k1.0-0000"}
    assert got[(2.0, "test")] == {"k2.0-0000"}


@pytest.mark.parametrize("limits", [{}, {"heavy_rows": 0, "chunk_rows": 20}], ids=["rank", "cut"])
def test_split_over_days_and_ties(spark, limits):
    times = [86400 * (i // 30) + (0 if i % 2 else i) for i in range(200)]
    df = labelled(spark, {0.0: times, 1.0: [0] * 100})
    got = split_of(df, **limits)
    for label, n in ((0.0, 200), (1.0, 100)):
        rows = sorted(
            ((t, f"k{label}-{i:04d}") for i, t in enumerate(times if label == 0.0 else [0] * 100))
        )
        cut = int(n * 0.8)
        assert got[(label, "train")] == {k for _, k in rows[:cut]}
        assert got[(label, "test")] == {k for _, k in rows[cut:]}


def test_split_does_not_shuffle_the_rows(spark):
    df = labelled(spark, {0.0: range(50), 1.0: range(50)})
    plan = chronological_split(df)._jdf.queryExecution().executedPlan().toString()
    top = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in top and "BroadcastHashJoin" in top


def test_gate(spark):
    row = training_gate(ledger(spark)).first()
    assert (row["n_rows"], row["n_labels"], row["ready"]) == (320, 2, True)
    assert not training_gate(ledger(spark, 250, 0)).first()["ready"]
    assert not training_gate(ledger(spark, 120, 70)).first()["ready"]
    assert not training_gate(ledger(spark).limit(0)).first()["ready"]


def test_train_and_evaluate(spark, tmp_path):
    df = ledger(spark)
    trained = train_and_evaluate(df, trees=10)
    row = trained.metrics.first()
    assert trained.metrics.columns == [
        "train_size", "test_size", "test_attack_count", "precision", "recall", "auc",
    ]
    assert (row["train_size"], row["test_size"], row["test_attack_count"]) == (256, 64, 14)
    assert row["recall"] > 0.5 and 0 <= row["precision"] <= 1 and row["auc"] == 1.0

    path = str(tmp_path / "model")
    save_model(trained.model, path)
    built = build_features(df)
    kept = [
        sorted(tuple(r) for r in predict(m, built).select("idempotency_key", "ml_score").collect())
        for m in (trained.model, load_model(path))
    ]
    assert kept[0] == kept[1]


def test_the_gate_stands_before_training(spark):
    for few in (ledger(spark, 250, 0), ledger(spark, 50, 70)):
        with pytest.raises(ValueError, match="not enough to train on"):
            train_and_evaluate(few, trees=1)


def test_fitting_is_bounded_and_counts_are_not(spark):
    df = ledger(spark)
    kept = bounded_sample(df, 320, 100).count()
    assert 70 < kept < 130 and bounded_sample(df, 320, 320) is df
    row = train_and_evaluate(df, trees=2, max_rows=150).metrics.first()
    assert (row["train_size"], row["test_size"]) == (256, 64)


def test_the_trees_are_fitted_on_every_training_row(spark, monkeypatch):
    """Unless the caller bounds them; and their thresholds come from every row, bins in order."""
    from riskweave.operators import model as module

    fitted, keep = [], module.materialize

    def kept(df, name):
        out = keep(df, name)
        if name == "training":
            fitted.append(out)
        return out

    monkeypatch.setattr(module, "materialize", kept)
    monkeypatch.setattr(module, "bounded_sample", lambda rows, n, most: rows.limit(10))
    trained = train_and_evaluate(ledger(spark), trees=1)
    assert fitted[0].agg(F.sum("rows")).first()[0] == trained.metrics.first()["train_size"] == 256

    # More combinations than Spark samples at 256 bins, and a feature with more values than bins.
    rows = spark.range(210_000).selectExpr(
        "cast(id % 700 as bigint) AS amount_cents", "cast(id div 700 % 100 as int) AS hour_of_day", "cast(id div 70000 as int) AS weekday",
        "0 AS is_high_risk_mcc", "0 AS velocity_count", "0 AS category_seen_before", "0D AS geo_speed_kmh",
        "0 AS rule_flag_count", "cast(id % 700 >= 350 as double) AS label",
    )
    trees = module.train(rows, trees=1).stages[-1]
    counted = fitted[1].count()
    assert 256**2 < counted <= trees.getMaxBins() ** 2 and counted < 210_000
    assert "feature 0 <=" in trees.toDebugString and " in {" not in trees.toDebugString


def test_train_save_and_score(spark, tmp_path):
    df = ledger(spark)
    txns = df.select(
        "idempotency_key", "account_id", "amount_cents", "merchant_category", "city", "occurred_at",
        F.when(F.col("label") == 1, F.lit("attack-sim")).otherwise(F.lit("b")).alias("bank"),
    )
    flags = spark.createDataFrame(
        [(k, a, 1, "c", "r", at(0), "pending", None, at(0), at(0)) for k, a in (("raid-3", "mule-0"), ("calm-5", "holder-5"))],
        FLAG,
    )
    trained, scored = train_and_rescore(txns, flags, str(tmp_path / "m"), trees=5)
    assert trained.metrics.first()["test_size"] == 64
    assert all(0 <= r["ml_score"] <= 1 for r in scored.collect())


def test_metrics_when_undefined(spark):
    df = spark.createDataFrame(
        [(0.0, 0.1, 0), (0.0, 0.2, 0)], "label double, ml_score double, predicted int"
    )
    row = held_out_metrics(df).first()
    assert (row["precision"], row["recall"]) == (0.0, 0.0) and math.isnan(row["auc"])


@pytest.mark.parametrize("chunk_rows", [1 << 20, 7])
@pytest.mark.parametrize("step", [1, 9, 100])
def test_auc_is_exact(spark, step, chunk_rows):
    """Also where many rows share a score and the classes of scores are cut into chunks."""
    rows = [(float(i % 3 == 0 or i > 80), (i // step) / 100, int(i > 50)) for i in range(100)]
    df = spark.createDataFrame(rows, "label double, ml_score double, predicted int")
    pos = [s for y, s, _ in rows if y == 1]
    neg = [s for y, s, _ in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    row = held_out_metrics(df, chunk_rows=chunk_rows).first()
    assert row["auc"] == pytest.approx(wins / len(pos) / len(neg))
    hits = sum(y == 1 and p == 1 for y, _, p in rows)
    assert (row["precision"], row["recall"]) == pytest.approx((hits / 49, hits / len(pos)))


def test_metrics_scan_the_predictions_once(spark, tmp_path):
    """The rows are deleted after the classes of scores are written; the metrics still come."""
    path = str(tmp_path / "predictions")
    spark.createDataFrame([(float(i % 2), i / 7, i % 2) for i in range(40)], "label double, ml_score double, predicted int").write.parquet(path)
    metrics = held_out_metrics(spark.read.parquet(path))
    shutil.rmtree(path)
    assert metrics.first()["test_size"] == 40


def test_bins_are_cut_at_quantiles_and_around_heavy_values():
    low, high, above = -math.inf, math.inf, lambda value: math.nextafter(value, math.inf)
    assert rough_cuts([1.0, 2.0, 3.0]) == [low, 1.0, 2.0, 3.0, high]
    assert rough_cuts([0.0, 0.0, 0.0, 5.0]) == [low, 0.0, above(0.0), 5.0, high]
    assert middle_cuts([(0.0, 0.0), (2.0, 4.0), (8.0, 9.0)]) == [low, above(1.0), above(6.0), high]
    assert middle_cuts([(1.0, 1.0), (above(1.0), 2.0)]) == [low, above(1.0), high]


def test_the_trees_are_fitted_on_counted_rows(spark, monkeypatch):
    """Copies of the rows add no row to what every pass of boosting reads, and change no score."""
    from riskweave.operators import model as module

    fitted, keep = [], module.materialize

    def kept(df, name):
        out = keep(df, name)
        if name == "training":
            fitted.append(out)
        return out

    monkeypatch.setattr(module, "materialize", kept)
    once = build_features(ledger(spark, 1500, 300))
    copies = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(4)))).drop("copy")
    scores = [
        {r["idempotency_key"]: r["ml_score"] for r in predict(train(df, trees=3), once).collect()}
        for df in (once, copies)
    ]
    sizes = [(rows.count(), rows.agg(F.sum("rows")).first()[0]) for rows in fitted]
    assert sizes[0][0] == sizes[1][0] < 1800 and [s for _, s in sizes] == [1800, 7200]
    assert scores[0].keys() == scores[1].keys()
    assert all(abs(scores[0][k] - scores[1][k]) < 1e-9 for k in scores[0])


def test_score_pending_scores_each_flag_once(spark):
    df = ledger(spark)
    model = train(build_features(df), trees=5)
    base = [
        ("raid-3", "mule-0", None),
        ("calm-5", "holder-5", 0.123),
        ("calm-7", "holder-7", None),
        ("gone", "acct-x", None),
    ]
    flags = spark.createDataFrame(
        [(k, a, 1, "c", "r", at(0), "pending", s, at(0), at(0)) for k, a, s in base], FLAG
    )
    after = {
        r["idempotency_key"]: r["ml_score"]
        for r in score_pending(flags, df.drop("rule_flag_count"), model).collect()
    }
    assert after["calm-5"] == 0.123 and after["gone"] is None
    assert after["raid-3"] > 0.5 > after["calm-7"]
    full = predict(model, build_features(df.withColumn("rule_flag_count", F.lit(0))))
    assert set(after) == {"raid-3", "calm-5", "calm-7", "gone"} and full.count() == 320


def test_a_model_of_other_features_is_refused(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from riskweave.constants import FEATURE_COLUMNS

    path = str(tmp_path / "model")
    swapped = [FEATURE_COLUMNS[1], FEATURE_COLUMNS[0], *FEATURE_COLUMNS[2:]]
    for columns in (swapped, FEATURE_COLUMNS[:-1]):
        other = Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features")])
        save_model(other.fit(spark.createDataFrame([(1,)], "n int")), path)
        with pytest.raises(ValueError, match="was fitted on"):
            load_model(path)
