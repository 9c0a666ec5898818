"""Flag table, review, presentation and evaluation."""

from __future__ import annotations

import pytest
from conftest import at, frame, txn
from pyspark.sql import functions as F

from riskweave.operators.evaluate import COUNTS, evaluate, ratios, report
from riskweave.operators.flags import (
    FLAG_COLUMNS,
    flag_by_key,
    flags_by_rule,
    new_flags,
    presentation,
    review,
    review_queue,
    status_counts,
    status_filter,
    upsert_flags,
)
from riskweave.schemas import FLAG
from riskweave.sources.tables import (
    bucket_of,
    read_flag,
    read_flags,
    read_transactions,
    replace_flags,
    touched_buckets,
    write_transactions,
)


def flag(key, status="pending", score=None, reasons="old", seconds=0):
    return (key, "acct", 100, "5814", reasons, at(seconds), status, score, at(0), at(0))


def flags(spark, *rows):
    return spark.createDataFrame(list(rows), FLAG)


def scored(spark, *pairs):
    df = frame(spark, [txn(key) for key, _ in pairs])
    texts = spark.createDataFrame(list(pairs), "idempotency_key string, reasons string")
    return df.join(texts, "idempotency_key")


def as_of(seconds):
    return F.lit(at(seconds)).cast("timestamp")


def test_upsert_keeps_decisions_scores_and_stale_flags(spark):
    current = flags(spark, flag("a", "approved", 0.9), flag("b"), flag("c", "denied", 0.1))
    found = scored(spark, ("a", "new text"), ("b", "old"), ("d", "first"))
    after = {r["idempotency_key"]: r for r in upsert_flags(current, found, as_of(60)).collect()}
    assert set(after) == set("abcd")
    a = after["a"]
    assert (a["status"], a["ml_score"], a["reasons"]) == ("approved", 0.9, "new text")
    assert a["updated_at"] > a["created_at"]
    assert (after["c"]["status"], after["c"]["reasons"]) == ("denied", "old")
    assert after["c"]["updated_at"] == after["c"]["created_at"]
    d = after["d"]
    assert (d["status"], d["ml_score"]) == ("pending", None)
    assert [r["idempotency_key"] for r in new_flags(current, found).collect()] == ["d"]


def test_upsert_twice_adds_nothing(spark):
    found = scored(spark, ("a", "x"), ("b", "y"))
    once = upsert_flags(flags(spark), found, as_of(1))
    twice = upsert_flags(once, found, as_of(1))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_review(spark):
    current = flags(spark, flag("a"), flag("b", "approved"), flag("c"))
    decisions = spark.createDataFrame(
        [
            ("a", "approved", at(1)),
            ("a", "denied", at(2)),
            ("b", "denied", at(1)),
            ("zzz", "denied", at(1)),
        ],
        "idempotency_key string, decision string, decided_at timestamp",
    )
    after = {r["idempotency_key"]: r["status"] for r in review(current, decisions).collect()}
    assert after == {"a": "denied", "b": "denied", "c": "pending"}
    bad = decisions.limit(1).withColumn("decision", F.lit("maybe"))
    with pytest.raises(Exception, match="unknown decision"):
        review(current, bad).collect()


def test_queue_and_counts(spark):
    table = flags(
        spark, flag("a", seconds=1), flag("b", seconds=3), flag("c", "approved", seconds=2)
    )
    assert [r["idempotency_key"] for r in review_queue(table).collect()] == ["b", "a"]
    assert [r["idempotency_key"] for r in review_queue(table, "odd", 1).collect()] == ["b"]
    assert [r["idempotency_key"] for r in status_filter(table, "approved").collect()] == ["c"]
    assert {r["status"]: r["n"] for r in status_counts(table).collect()} == {
        "pending": 2,
        "approved": 1,
        "denied": 0,
    }
    assert flag_by_key(table, "c").first()["status"] == "approved"
    assert flag_by_key(table, "none").isEmpty()


def test_presentation(spark):
    table = flags(
        spark,
        flag("a", reasons="velocity: x\n \nmcc_drift: y"),
        flag("b", score=0.87, reasons=""),
        flag("c", score=0.3),
        flag("d", score=0.29, seconds=86400),
    )
    rows = {r["idempotency_key"]: r for r in presentation(table).collect()}
    assert rows["a"]["reason_list"] == ["velocity: x", "mcc_drift: y"]
    assert rows["a"]["reasons_text"] == "velocity: x · mcc_drift: y"
    assert rows["a"]["ml_risk"] == "scoring…" and rows["a"]["risk_band"] == "unscored"
    assert rows["b"]["reason_list"] == [] and rows["b"]["ml_risk"] == "87.0%"
    assert [rows[k]["risk_band"] for k in "bcd"] == ["high", "medium", "low"]
    assert rows["a"]["amount"] == "$1.00"
    assert rows["d"]["occurred_text"] == "Jan 2, 09:00:00"
    counts = {r["rule"]: r["n"] for r in flags_by_rule(table).collect()}
    assert counts == {"velocity": 1, "mcc_drift": 1, "old": 2}


def test_flag_store_replaces_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "flags")
    assert read_flags(spark, path).isEmpty()
    replace_flags(flags(spark, *[flag(f"k{i}") for i in range(40)]), path, 8)
    found = scored(spark, ("k1", "newer"), ("k-new", "first"))
    touched = touched_buckets(found, "idempotency_key", 8)
    assert 1 <= len(touched) <= 2
    replace_flags(upsert_flags(read_flags(spark, path, touched), found, as_of(9)), path, 8)
    after = {r["idempotency_key"]: r["reasons"] for r in read_flags(spark, path).collect()}
    assert len(after) == 41 and after["k1"] == "newer" and after["k2"] == "old"
    one = read_flag(spark, path, "k1", 8)
    assert one.first()["reasons"] == "newer" and one.columns == list(FLAG_COLUMNS)
    files = one.inputFiles()
    bucket = spark.range(1).select(bucket_of(F.lit("k1"), 8).alias("b")).first()["b"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(key_bucket" in plan and f"= {bucket})" in plan and files


def test_transaction_store_prunes_buckets_and_columns(spark, tmp_path):
    from test_ingest import txns

    path = str(tmp_path / "txns")
    rows = txns(spark, [("bank-a", str(i), 5, i) for i in range(30)]).withColumn(
        "account_id", F.concat(F.lit("a"), F.col("native_id"))
    )
    assert read_transactions(spark, path).isEmpty()
    write_transactions(rows, path, 4)
    assert read_transactions(spark, path).count() == 30
    some = read_transactions(spark, path, ["idempotency_key", "account_id"], [0, 2])
    assert 0 < some.count() < 30
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [account_bucket" in plan.replace("isnotnull(account_bucket), ", "")
    assert "merchant_name" not in plan.split("ReadSchema")[1]


CASES = [
    ((20, 10000, 20, 0), (1.0, 1.0, 0.0)),
    ((20, 10060, 16, 71), (16 / 87, 16 / 20, 71 / 10060)),
    ((20, 10000, 0, 0), (None, 0.0, 0.0)),
    ((0, 10000, 0, 5), (0.0, None, 5 / 10000)),
    ((20, 0, 20, 0), (1.0, 1.0, None)),
    ((0, 0, 0, 0), (None, None, None)),
]


@pytest.mark.parametrize(("counts", "expected"), CASES)
def test_ratios(spark, counts, expected):
    df = spark.createDataFrame([counts], ", ".join(f"{c} bigint" for c in COUNTS))
    row = ratios(df).first()
    assert tuple(row)[4:] == expected
    texts = report(ratios(df)).first()
    assert [t == "n/a" for t in tuple(texts)[4:]] == [e is None for e in expected]


def test_evaluate_tables(spark):
    names = [("attack-sim", i) for i in range(2)] + [("bank-a", i) for i in range(8)]
    rows = spark.createDataFrame([(b,) for b, _ in names], "bank string")
    table = flags(spark, flag("attack-sim:0"), flag("attack-sim:1"), flag("bank-a:0"))
    row = evaluate(rows, table).first()
    assert row.asDict() == {
        "attack_transactions": 2,
        "legit_transactions": 8,
        "attack_flagged": 2,
        "legit_flagged": 1,
        "precision": 2 / 3,
        "recall": 1.0,
        "false_positive_rate": 1 / 8,
    }
    empty = evaluate(rows.limit(0), flags(spark)).first()
    assert tuple(empty) == (0, 0, 0, 0, None, None, None)


def test_prefix_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    flags(spark, flag("attack-sim:0")).write.parquet(path)
    df = spark.read.parquet(path).filter(F.col("idempotency_key").startswith("attack-sim:"))
    assert "StringStartsWith" in df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_accounts_need_no_shuffle(spark, tmp_path):
    from riskweave.operators.rules import score
    from riskweave.sources.tables import save_account_table

    rows = [txn(f"k{i}", f"acct-{i % 9}", seconds=i) for i in range(90)]
    save_account_table(frame(spark, rows), "by_account", str(tmp_path / "t"), 4)
    try:
        fired = score(spark.table("by_account"))
        plan = fired._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert fired.count() == score(frame(spark, rows)).count()
    finally:
        spark.sql("DROP TABLE by_account")


def test_insert_is_idempotent(spark, tmp_path):
    from test_ingest import txns

    from riskweave.sources.tables import insert_transactions

    path = str(tmp_path / "t")
    rows = txns(spark, [("bank-a", str(i), 5, i) for i in range(9)])
    for _ in range(2):
        insert_transactions(rows.unionByName(rows), path, 2)
    assert read_transactions(spark, path).count() == 9
