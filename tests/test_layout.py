"""Tables by date and account, and numbers taken while a batch is written."""

from __future__ import annotations

import shutil
from datetime import timedelta

from conftest import T0
from pyspark.sql import functions as F
from test_ingest import txns

from riskweave.sources.tables import (
    bucket_of,
    read_dated_transactions,
    write_dated_transactions,
    write_observed,
)


def test_a_look_back_reads_the_folders_of_its_days_and_buckets(spark, tmp_path):
    path = str(tmp_path / "dated")
    # A row an hour over ten days, written in two parts.
    rows = txns(spark, [("bank-a", str(i), 5, 3600 * i) for i in range(240)])
    rows = rows.withColumn("account_id", F.concat(F.lit("a"), F.col("native_id").cast("int") % 20))
    for part in (rows.filter("cast(native_id as int) % 2 = 0"), rows.filter("cast(native_id as int) % 2 = 1")):
        write_dated_transactions(part, path, 4)
    first, last = T0 + timedelta(days=5), T0 + timedelta(days=5, hours=2)
    got = read_dated_transactions(spark, path, first, last, 120)
    want = rows.filter(F.col("occurred_at").between(F.lit(first - timedelta(seconds=120)), F.lit(last)))
    assert sorted(r.native_id for r in got.collect()) == sorted(r.native_id for r in want.collect())
    one = [r.b for r in want.select(bucket_of(F.col("account_id"), 4).alias("b")).limit(1).collect()]
    few = read_dated_transactions(spark, path, first, last, 120, ["idempotency_key"], one)
    listed = few.select(F.input_file_name().alias("f")).distinct().collect()
    assert 0 < len(listed) <= 2 * 2 and all(f"account_bucket={one[0]}/" in r.f for r in listed)
    assert {r.f.split("event_date=")[1][:10] for r in listed} <= {str((first - timedelta(seconds=120)).date()), str(last.date())}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(occurred_at" in plan
    # A table that is not there has no rows; columns that it lacks are NULL.
    assert read_dated_transactions(spark, str(tmp_path / "none"), first, last).isEmpty()
    write_dated_transactions(rows.drop("city", "raw").limit(1), str(tmp_path / "short"), 1)
    assert read_dated_transactions(spark, str(tmp_path / "short"), T0, T0 + timedelta(days=10)).first()["city"] is None


def test_numbers_come_from_the_write_itself(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(50).write.parquet(source)
    rows = spark.read.parquet(source)
    metrics = {"n": F.count(F.lit(1)), "even": F.count_if(F.col("id") % 2 == 0), "top": F.max("id")}
    got = write_observed(rows, target, 3, metrics)
    shutil.rmtree(source)
    assert got == {"n": 50, "even": 25, "top": 49}
    # A replay, with other rows, has the numbers of what was written.
    assert write_observed(spark.range(7), target, 3, metrics) == got
    assert write_observed(spark.range(0), target, 4, metrics) == {"n": 0, "even": 0, "top": None}
