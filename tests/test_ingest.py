"""Feeds, envelopes, validation, deduplication and retry routing."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from conftest import at
from pyspark.sql import functions as F

from riskweave.functions import micros, parse_rfc3339
from riskweave.operators.dedupe import (
    batch_tally,
    dedupe_against_store,
    dedupe_feed,
    dedupe_first,
)
from riskweave.operators.normalize import feed_counts, normalize_feed, union_feeds
from riskweave.operators.validate import (
    accepted,
    add_missing_columns,
    dead_letters,
    flag_violations,
    rejected,
    require_columns,
    retries,
    route_failures,
    status_or_default,
    validate,
)
from riskweave.plans.batch import complete_pages
from riskweave.sources.envelopes import parse_envelope, to_envelope, unparseable
from riskweave.sources.feeds import (
    FEEDS,
    Feed,
    delivery_gaps,
    explode_pages,
    parse_records,
    read_feed,
    unreadable_pages,
)

def now():
    return F.lit("2026-02-01 00:00:00").cast("timestamp")


A = FEEDS["bank-a"]


def record(i=0, **over):
    base = {
        "tx_id": f"r{i}",
        "acct": "holder-9",
        "amount": 4.35,
        "merchant": "Corner Bakery",
        "mcc": "5462",
        "ts": "2026-03-14T15:09:26Z",
    }
    return {**base, **over}


def native(spark, records, feed=A):
    bodies = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return parse_records(spark.createDataFrame(bodies, "body string"), feed)


def normal(spark, records, feed=A, **kw):
    return normalize_feed(native(spark, records, feed), feed, as_of=now(), **kw)


def test_truncation_and_rounding(spark):
    # 4.35 is a little less than that in binary: 434.99999999999994 cents.
    assert normal(spark, [record()]).first()["amount_cents"] == 434
    assert normal(spark, [record()], rounding="half_up").first()["amount_cents"] == 435
    assert normal(spark, [record(amount=-2.5)]).first()["amount_cents"] == -250
    with pytest.raises(ValueError):
        normal(spark, [record()], rounding="up")


def test_missing_and_mistyped_fields(spark):
    row = normal(spark, [record(merchant=5, amount="12", acct=None)]).first()
    assert (row["merchant_name"], row["amount_cents"], row["account_id"]) == ("", 0, "")
    assert row["city"] == ""
    assert row["currency"] == "USD"
    assert row["idempotency_key"] == "bank-a:r0"


def test_bad_timestamps(spark):
    bad = ["2026-01-01", "2026-01-01 09:00:00", "2026-13-01T09:00:00Z", None, 5]
    rows = normal(spark, [record(ts=t) for t in bad]).collect()
    assert [r["error"] for r in rows] == ["bad timestamp"] * len(bad)
    with pytest.raises(Exception, match="bad timestamp"):
        normal(spark, [record(ts="x")], on_error="fail").collect()
    assert normal(spark, [record()], on_error="fail").first()["error"] is None


def test_offset_timestamp(spark):
    text = F.lit("2026-01-01T09:00:00.123456+02:00")
    got = spark.range(1).select(micros(parse_rfc3339(text)).alias("us")).first()["us"]
    want = datetime(2026, 1, 1, 7, 0, 0, 123456, tzinfo=timezone.utc)
    assert got == int(want.timestamp()) * 1_000_000 + 123456


def test_feeds_b_and_c(spark):
    b = {
        "id": "1", "account_number": "a", "amount_cents": 250, "desc": "m",
        "category_code": "5411", "city_name": "Miami", "posted_at": "2026-01-01T09:00:00Z",
    }
    c = {
        "uuid": "1", "account": "a", "cents": 250, "payee": "m",
        "category": "5411", "loc": "Miami", "when": "2026-01-01T09:00:00Z",
    }
    flow = union_feeds(
        {
            "bank-b": native(spark, [b], FEEDS["bank-b"]),
            "bank-c": native(spark, [c], FEEDS["bank-c"]),
        },
        as_of=now(),
    )
    rows = flow.drop("raw", "bank", "idempotency_key").distinct().collect()
    assert len(rows) == 1 and rows[0]["amount_cents"] == 250 and rows[0]["city"] == "Miami"
    assert {r["idempotency_key"] for r in flow.collect()} == {"bank-b:1", "bank-c:1"}


def test_a_fourth_feed_is_data(spark):
    feed = Feed("bank-d", "i", "a", "m", "c", "l", "t", "v")
    body = {"i": "9", "a": "x", "m": "n", "c": "1", "l": "Miami", "t": record()["ts"], "v": 7}
    flow = union_feeds(
        {"bank-d": native(spark, [body], feed)}, as_of=now(), feeds={"bank-d": feed}
    )
    assert flow.first()["idempotency_key"] == "bank-d:9"


def test_read_feed_lines_and_arrays(spark, tmp_path):
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(record(i)) for i in range(3)))
    (tmp_path / "array.json").write_text(json.dumps([record(i) for i in range(3)]))
    lines = read_feed(spark, str(tmp_path / "lines.json"), A)
    array = read_feed(spark, str(tmp_path / "array.json"), A, array_file=True)
    for df in (lines, array):
        keys = [r["native_id"] for r in normalize_feed(df, A, as_of=now()).collect()]
        assert sorted(keys) == [f"r{i}" for i in range(3)]


@pytest.mark.parametrize("n", [40, 41, 50, 60])
def test_page_overlap_keeps_first(spark, n):
    """Pages of ten; every page whose number is divisible by four repeats the record before it."""
    pages = []
    for page_no, start in enumerate(range(0, n, 10)):
        served = [record(i, merchant=f"page-{page_no}") for i in range(start, min(start + 10, n))]
        if page_no and page_no % 4 == 0:
            served.insert(0, record(start - 1, merchant=f"page-{page_no}"))
        body = {"transactions": served, "next_cursor": str(page_no + 1)}
        pages.append((page_no, json.dumps(body)))
    pages.append((len(pages), json.dumps({"transactions": [], "next_cursor": ""})))
    records = explode_pages(spark.createDataFrame(pages, "page_no int, body string"), A)
    kept = dedupe_feed(normalize_feed(records, A, as_of=now())).collect()
    assert len(kept) == n
    names = {r["native_id"]: r["merchant_name"] for r in kept}
    assert names.get("r39") == "page-3"


def txns(spark, rows):
    full = [
        (f"{b}:{i}", b, i, "acct", c, "USD", "m", "5814", None, at(s), at(0), "raw")
        for b, i, c, s in rows
    ]
    return spark.createDataFrame(
        full,
        "idempotency_key string, bank string, native_id string, account_id string, "
        "amount_cents bigint, currency string, merchant_name string, merchant_category string, "
        "city string, occurred_at timestamp, ingested_at timestamp, raw string",
    )


def test_duplicate_delivery(spark):
    batch = txns(spark, [("bank-a", "1", 5, 0), ("bank-a", "1", 5, 0), ("bank-b", "1", 5, 0)])
    empty = txns(spark, []).select("idempotency_key")
    kept = dedupe_against_store(batch, empty, "occurred_at").collect()
    assert sorted(r["idempotency_key"] for r in kept) == ["bank-a:1", "bank-b:1"]
    store = txns(spark, [("bank-a", "1", 5, 0)])
    kept = dedupe_against_store(batch, store, "occurred_at").collect()
    assert [r["idempotency_key"] for r in kept] == ["bank-b:1"]
    tally = batch_tally(validate(batch), store).collect()
    assert {r["outcome"]: r["n"] for r in tally} == {"accepted": 1, "duplicate": 2, "invalid": 0}


def test_hot_key_is_limited_before_the_shuffle(spark):
    copies = txns(spark, [("bank-a", "1", i + 1, i) for i in range(200)])
    kept = dedupe_first(copies, "occurred_at")
    assert [r["amount_cents"] for r in kept.collect()] == [1]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_validation(spark):
    rows = [("", "1", 5, 0), ("bank-a", "", 5, 0), ("bank-a", "2", 0, 0), ("bank-a", "3", -500, 0)]
    checked = validate(txns(spark, rows))
    errors = [r["error"] for r in checked.orderBy("idempotency_key").collect()]
    missing = "schema: transaction missing bank or native_id"
    zero = "schema: transaction bank-a:2 has zero amount"
    assert sorted(e for e in errors if e) == sorted([missing, missing, zero])
    assert [r["native_id"] for r in accepted(checked).collect()] == ["3"]
    out = {r["message_id"]: r for r in rejected(checked).collect()}
    assert out["bank-a:2"]["reason"].startswith("gave up after 3 retries: schema:")
    assert out["bank-a:2"]["retry_count"] == 0


def test_invalid_row_does_not_hide_a_valid_one(spark):
    batch = validate(txns(spark, [("bank-a", "1", 0, 0), ("bank-a", "1", 7, 1)]))
    empty = txns(spark, []).select("idempotency_key")
    kept = dedupe_against_store(accepted(batch), empty, "occurred_at").collect()
    assert [r["amount_cents"] for r in kept] == [7]


def test_feed_counts(spark):
    df = txns(spark, [("bank-a", "1", 5, 0), ("bank-a", "2", 0, 0), ("bank-b", "1", 5, 0)])
    got = {r["bank"]: (r["fetched"], r["published"]) for r in
           feed_counts(validate(df)).collect()}
    assert got == {"bank-a": (2, 1), "bank-b": (1, 1), "total": (3, 2)}


def test_retry_routing(spark):
    failed = spark.createDataFrame(
        [("b", f"m{n}", n, "boom") for n in (0, 2, 3, 4)] + [("b", "m-none", None, "boom")],
        "body string, message_id string, retry_count int, error string",
    )
    routed = route_failures(failed, as_of=now())
    again = {r["message_id"]: r for r in retries(routed).collect()}
    assert {k: r["retry_count"] for k, r in again.items()} == {"m0": 1, "m2": 3, "m-none": 1}
    due = retries(routed).select(micros(F.col("available_at")).alias("d")).distinct().collect()
    start = spark.range(1).select(micros(now()).alias("n")).first()["n"]
    assert [r["d"] - start for r in due] == [2_000_000]
    dead = {r["message_id"]: r["reason"] for r in dead_letters(routed).collect()}
    assert dead == {
        "m3": "gave up after 3 retries: boom",
        "m4": "gave up after 4 retries: boom",
    }


def test_envelope_round_trip(spark):
    df = txns(spark, [("bank-a", "1", 5, 0.25)]).withColumn("raw", F.lit('{"x":1}'))
    messages = to_envelope(df)
    message = messages.first()
    assert message["message_id"] == "bank-a:1" and message["retry_count"] == 0
    body = json.loads(message["body"])
    assert list(body) == [
        "bank", "native_id", "account_id", "amount_cents", "currency", "merchant_name",
        "merchant_category", "city", "timestamp", "raw",
    ]
    assert body["timestamp"] == "2026-01-01T09:00:00.25Z"
    back = parse_envelope(messages, now()).first()
    assert back["error"] is None and back["raw"] == '{"x":1}' and back["city"] == ""


@pytest.mark.parametrize(
    ("body", "error"),
    [
        ("{bad", "unmarshal error: malformed body"),
        ("", "unmarshal error: malformed body"),
        ("[1]", "unmarshal error: malformed body"),
        ('{"bank":5,"timestamp":"2026-01-01T09:00:00Z"}', "unmarshal error: not a string: bank"),
        ('{"amount_cents":"5"}', "unmarshal error: malformed body"),
        ('{"amount_cents":1.5}', "unmarshal error: malformed body"),
        ('{"bank":"b","native_id":"1"}', "unmarshal error: bad timestamp"),
        ('{"bank":null,"timestamp":"2026-01-01T09:00:00Z"}', None),
        ('{"timestamp":"2026-01-01T09:00:00Z"} and more', "unmarshal error: malformed body"),
        ('{"timestamp":"2026-01-01T09:00:00Z"}{"bank":"b"}', "unmarshal error: malformed body"),
        ('{"timestamp":"2026-01-01T09:00:00Z"},{"bank":"b"}', "unmarshal error: malformed body"),
        ("{'timestamp':'2026-01-01T09:00:00Z'}", "unmarshal error: malformed body"),
        ('{"b\\u0061nk":5,"timestamp":"2026-01-01T09:00:00Z"}', "unmarshal error: not a string: bank"),
        ('{"b\\u0061nk":"b","timestamp":"2026-01-01T09:00:00Z"}', None),
        ('{"timestamp":"2026-01-01T09:00:00Z\\n"}', "unmarshal error: bad timestamp"),
    ],
)
def test_envelope_errors(spark, body, error):
    df = spark.createDataFrame([(body, 1, "m")], "body string, retry_count int, message_id string")
    parsed = parse_envelope(df, now())
    assert parsed.first()["error"] == error
    assert [r["reason"] for r in unparseable(parsed).collect()] == ([error] if error else [])


def test_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert require_columns(df, {"a": "int"}) is df
    with pytest.raises(ValueError, match="city"):
        require_columns(df, {"city": "string"})
    filled = add_missing_columns(df, {"city": "string"})
    require_columns(filled, {"a": "int", "city": "string"})


def test_unknown_status_means_pending():
    assert status_or_default("approved") == "approved"
    assert status_or_default("x") == status_or_default(None) == "pending"


def test_flag_violations(spark):
    rows = [
        ("a", "x", 1, "c", at(0), "pending"),
        ("a", "x", 1, "c", at(0), "approved"),
        ("b", None, 1, "c", at(0), "odd"),
        (None, "x", None, "", None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "idempotency_key string, account_id string, amount_cents bigint, "
        "merchant_category string, occurred_at timestamp, status string",
    )
    got = {(r["idempotency_key"], r["violation"]) for r in flag_violations(df).collect()}
    assert got == {
        ("a", "idempotency_key not unique"),
        ("b", "account_id missing"),
        ("b", "status not allowed"),
        (None, "idempotency_key missing"),
        (None, "amount_cents missing"),
        (None, "merchant_category missing"),
        (None, "occurred_at missing"),
        (None, "status not allowed"),
    }


def test_a_body_is_parsed_and_its_fields_are_typed_once(spark):
    """However often they are mentioned: finding a type takes longer than reading the text."""
    messages = spark.createDataFrame([("{}", "m", 0)], "body string, message_id string, retry_count int")
    parsed = parse_envelope(messages, F.lit("2026-01-01").cast("timestamp")).filter("error is null")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString().lower()
    assert (plan.count("from_json("), plan.count("schemaofvariant(")) == (1, 9)


def test_flag_violations_scan_the_flags_once_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    """Also where keys compress so well that adaptive execution would make one task of them."""
    from riskweave.operators import skew

    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    path = str(tmp_path / "flags")
    key = F.concat(F.lit("k"), (F.col("id") % 900).cast("string")).alias("idempotency_key")
    odd = F.when(F.col("id") >= 900, F.lit("odd")).otherwise(F.lit("denied")).alias("status")
    columns = {"account_id": "x", "amount_cents": 1, "merchant_category": "c", "occurred_at": at(0)}
    rows = spark.range(1000).select(key, odd, *[F.lit(v).alias(c) for c, v in columns.items()])
    rows.write.parquet(path)
    found = flag_violations(spark.read.parquet(path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert found.rdd.getNumPartitions() == 10
    texts = found.groupBy("violation").count().collect()
    assert {tuple(r) for r in texts} == {("status not allowed", 100), ("idempotency_key not unique", 100)}


def test_amounts_out_of_range_are_quarantined(spark):
    rows = normal(spark, [record(0, amount=1e300), record(1)]).collect()
    assert {r["native_id"]: r["error"] for r in rows} == {
        "r0": "amount out of range",
        "r1": None,
    }


def test_misfit_records_keep_their_text(spark, tmp_path):
    lines = ["{bad", json.dumps(record(amount="12")), json.dumps(record())]
    path = tmp_path / "lines.json"
    path.write_text("\n".join(lines))
    for df in (native(spark, lines), read_feed(spark, str(path), A)):
        rows = rejected(validate(normalize_feed(df, A, as_of=now()))).collect()
        assert sorted(r["body"] for r in rows) == sorted(lines[:2])


def test_unreadable_pages_are_reported(spark):
    good = json.dumps({"transactions": [record()], "next_cursor": ""})
    pages = spark.createDataFrame([(0, good), (1, good[:-9]), (2, "")], "page_no int, body string")
    found = unreadable_pages(pages, A).collect()
    assert sorted(r["message_id"] for r in found) == ["bank-a:page-1", "bank-a:page-2"]
    assert explode_pages(pages, A).count() == 1


def test_nested_fields_do_not_count_as_wrong_types(spark):
    body = json.dumps(
        {
            "bank": "b",
            "native_id": "1",
            "merchant_name": 'odd "bank":5 name',
            "timestamp": "2026-01-01T09:00:00Z",
            "raw": {"city": 5, "bank": None},
        }
    )
    df = spark.createDataFrame([(body, 0, "m")], "body string, retry_count int, message_id string")
    row = parse_envelope(df, now()).first()
    assert row["error"] is None and row["merchant_name"] == 'odd "bank":5 name'
    assert json.loads(row["raw"]) == {"city": 5, "bank": None}


def test_topic_records_become_messages(spark):
    from riskweave.streaming.ingest import topic_messages

    source = to_envelope(txns(spark, [("bank-a", "1", 5, 0)]))
    records = source.select(
        F.col("message_id").cast("binary").alias("key"), F.col("body").cast("binary").alias("value")
    )
    columns = ["body", "retry_count", "message_id"]
    got = topic_messages(records).select(*columns).collect()
    assert got == source.select(*columns).collect()
    assert parse_envelope(topic_messages(records), now()).first()["error"] is None


def test_incomplete_deliveries_are_refused(spark):
    def page(no, next_cursor, body=None):
        served = {"transactions": [record(no)], "next_cursor": next_cursor}
        return (no, json.dumps(served) if body is None else body)

    def gaps(*pages):
        df = spark.createDataFrame(list(pages), "page_no int, body string")
        return {(r["page_no"], r["problem"]) for r in delivery_gaps(df, A).collect()}

    whole = (page(0, "1"), page(1, "2"), page(2, ""))
    assert gaps(*whole) == set()
    assert gaps(*whole[:2]) == {(1, "next page missing")}
    assert gaps(whole[0], whole[2]) == {(0, "next page missing")}
    assert gaps(*whole[1:]) == {(0, "first page missing")}
    assert gaps(page(0, ""), page(1, "")) == {(0, "page after the last")}
    assert gaps(whole[0], page(1, "2", '{"transactions": [{"tx'), whole[2]) == {(1, "unreadable page")}
    df = spark.createDataFrame(list(whole), "page_no int, body string")
    assert complete_pages(df, A).count() == 3
    with pytest.raises(ValueError, match="page 1: next page missing"):
        complete_pages(df.filter("page_no < 2"), A)
