"""Inputs that the registered queries derive from the test tables.

Each one covers every row of its table; the event's ``k`` (0 to 99, from its JSON
properties) decides which rows are dirty, and the event type decides the feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.constants import RuleSettings
from riskweave.functions import idempotency_key, rfc3339_text
from riskweave.operators.flags import FLAG_COLUMNS, as_new_flags, review
from riskweave.operators.rules import score
from riskweave.session import materialize
from riskweave.sources.envelopes import to_envelope
from riskweave.sources.feeds import FEEDS, parse_records
from riskweave.sources.harness import (
    event_category,
    event_city,
    event_k,
    event_transactions,
    instant,
    table,
)

# The events are sparse; a day-wide window makes the velocity rule fire on them.
DAY = RuleSettings(window_seconds=86_400)
HOUR = RuleSettings(window_seconds=3_600)
CUTOFF = "2024-01-15 00:00:00"
AS_OF = "2024-02-02 00:00:00"


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the event's own columns beside them."""
    return event_transactions(spark, sf_dir).withColumn(
        "k", F.get_json_object("raw", "$.k").cast("int")
    )


def _native_bodies() -> dict[str, tuple[Column, Column]]:
    """For each feed, which events are its own and how they look there as JSON.

    Feed B has a number where a text belongs on signups, feed C lacks the city for
    ``k < 5`` and has a date without a time for ``k = 13``.
    """
    ts = F.col("ts").cast("timestamp")
    later = ts + F.expr("interval 2 hours")
    offset_text = F.regexp_replace(rfc3339_text(later), "Z$", "+02:00")
    day_text = F.date_format(ts, "yyyy-MM-dd")
    account, key = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    cents = (F.col("value") * F.lit(100.0)).cast("bigint")
    kind = F.col("event_type")
    a = F.struct(
        key.alias("tx_id"),
        account.alias("acct"),
        F.col("value").alias("amount"),
        kind.alias("merchant"),
        event_category().alias("mcc"),
        event_city().alias("city"),
        rfc3339_text(ts).alias("ts"),
    )
    b = [
        key.alias("id"),
        account.alias("account_number"),
        cents.alias("amount_cents"),
        event_category().alias("category_code"),
        event_city().alias("city_name"),
        offset_text.alias("posted_at"),
    ]
    c = F.struct(
        key.alias("uuid"),
        account.alias("account"),
        cents.alias("cents"),
        kind.alias("payee"),
        event_category().alias("category"),
        F.when(event_k() >= 5, event_city()).alias("loc"),
        F.when(event_k() == 13, day_text).otherwise(rfc3339_text(ts)).alias("when"),
    )
    desc = F.when(kind == "signup", F.to_json(F.struct(*b, F.col("event_id").alias("desc")))).otherwise(
        F.to_json(F.struct(*b, kind.alias("desc")))
    )
    in_a, in_b = kind.isin("view", "purchase"), kind.isin("click", "signup")
    in_c = kind.isNull() | ~kind.isin("view", "purchase", "click", "signup")
    return {"bank-a": (in_a, F.to_json(a)), "bank-b": (in_b, desc), "bank-c": (in_c, F.to_json(c))}


def native_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The native records of each feed; the scan reads only the events of its types."""
    events = table(spark, sf_dir, "events")
    return {
        bank: parse_records(events.filter(mine).select(body.alias("body")), FEEDS[bank])
        for bank, (mine, body) in _native_bodies().items()
    }


def native_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a JSON record of one of the three feeds: ``(bank, event_id, body)``."""
    bank, body = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (mine, own) in _native_bodies().items():
        bank, body = F.when(mine, F.lit(name)).otherwise(bank), F.when(mine, own).otherwise(body)
    return table(spark, sf_dir, "events").select(bank.alias("bank"), "event_id", body.alias("body"))


PAGE_ROWS = 100


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed A's format as pages of 100 records; each page repeats the one before its first."""
    events = table(spark, sf_dir, "events")
    record = F.struct(
        F.col("event_id").cast("string").alias("tx_id"),
        F.col("user_id").cast("string").alias("acct"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant"),
        event_category().alias("mcc"),
        event_city().alias("city"),
        rfc3339_text(F.col("ts").cast("timestamp")).alias("ts"),
    )
    page = F.floor(F.col("event_id") / PAGE_ROWS)
    next_page = F.floor((F.col("event_id") + 1) / PAGE_ROWS)
    served = events.select(
        F.explode(F.array_distinct(F.array(page, next_page))).alias("page_no"),
        F.struct("event_id", record.alias("record")).alias("entry"),
    )
    rows = F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["record"])
    return served.groupBy("page_no").agg(rows.alias("transactions")).select(
        "page_no",
        F.to_json(
            F.struct("transactions", (F.col("page_no") + 1).cast("string").alias("next_cursor"))
        ).alias("body"),
    )


def _cursor(page: Column) -> Column:
    """A cursor that tells nothing about the order of pages; none for the first request."""
    return F.when(page == 0, F.lit("")).otherwise(F.md5(page.cast("string")))


def cursor_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed pages under cursors; the last one names no further page."""
    pages = landed_pages(spark, sf_dir)
    last = pages.agg(F.max("page_no").alias("last"))
    ends = F.col("page_no") == F.col("last")
    named = F.when(ends, F.lit("")).otherwise(_cursor(F.col("page_no") + 1))
    return pages.withColumn("one", F.lit(1)).join(F.broadcast(last.withColumn("one", F.lit(1))), "one").select(
        "page_no", _cursor(F.col("page_no")).alias("cursor"), _naming(F.col("body"), named).alias("body")
    )


def _naming(body: Column, cursor: Column) -> Column:
    """The page's text with another next cursor, which is its last field."""
    return F.concat(F.substring_index(body, '"next_cursor"', 1), F.lit('"next_cursor":"'), cursor, F.lit('"}'))


def damaged_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of pages in six deliveries: whole and served twice, and with five defects."""
    pages = materialize(cursor_pages(spark, sf_dir), "cursor-pages")
    body, n = F.col("body"), F.col("page_no")
    cut = F.substring(body, F.lit(1), F.length(body) - 10)
    deliveries = {
        "whole": pages.unionByName(pages),
        "unreadable": pages.withColumn("body", F.when(n == 2, cut).otherwise(body)),
        "hole": pages.filter(n != 3),
        "fork": pages.unionByName(pages.filter(n == 2).withColumn("body", _naming(body, _cursor(n + 2)))),
        "loop": pages.withColumn("body", F.when(n == 5, _naming(body, _cursor(n - 3))).otherwise(body)),
        "headless": pages.filter(n != 0),
    }
    named = [d.withColumn("delivery", F.lit(name)) for name, d in deliveries.items()]
    return reduce(DataFrame.unionByName, named).select("delivery", "cursor", "body")


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a bank (k = 7), without an id (k = 8) or with amount 0 (k = 9)."""
    rows = keyed_events(spark, sf_dir)
    k = F.col("k")
    return (
        rows.withColumn("bank", F.when(k == 7, F.lit("")).otherwise(F.col("bank")))
        .withColumn("native_id", F.when(k == 8, F.lit("")).otherwise(F.col("native_id")))
        .withColumn("amount_cents", F.when(k == 9, F.lit(0)).otherwise(F.col("amount_cents")))
        .withColumn("idempotency_key", idempotency_key(F.col("bank"), F.col("native_id")))
        .drop("k")
    )


def served_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction on two pages; the second serving has another amount."""
    first = event_transactions(spark, sf_dir).withColumns(
        {"page_no": F.lit(0), "pos": F.col("native_id").cast("bigint")}
    )
    again = first.withColumns(
        {"page_no": F.lit(1), "amount_cents": F.col("amount_cents") + 1_000_000}
    )
    return first.unionByName(again)


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of all events, damaged in four ways by decade of ``k``, the fifth without city."""
    messages = to_envelope(event_transactions(spark, sf_dir))
    body = F.col("body")
    k = F.get_json_object("body", "$.raw.k").cast("int")
    damaged = (
        F.when(k < 10, F.substring(body, F.lit(1), F.length(body) - 1))
        .when(k < 20, F.regexp_replace(body, '"bank":"[^"]*"', '"bank":5'))
        .when(k < 30, F.regexp_replace(body, r'"amount_cents":\d+', '"amount_cents":1.5'))
        .when(k < 40, F.regexp_replace(body, r'"timestamp":"([^T]*)T[^"]*"', '"timestamp":"$1"'))
        .when(k < 50, F.regexp_replace(body, '"city":"[^"]*",', ""))
        .otherwise(body)
    )
    return messages.withColumn("body", damaged)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a delivery that has been tried before; error events failed."""
    messages = to_envelope(event_transactions(spark, sf_dir))
    k = F.get_json_object("body", "$.raw.k").cast("int")
    failed = F.get_json_object("body", "$.merchant_name") == "error"
    return messages.withColumns(
        {
            "retry_count": F.pmod(k, F.lit(5)),
            "error": F.when(failed, F.concat(F.lit("no answer for "), F.col("message_id"))),
        }
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two decisions on every click, purchase and error: denied, then by amount."""
    txns = event_transactions(spark, sf_dir).filter(
        F.col("merchant_name").isin("click", "purchase", "error")
    )
    first = txns.select(
        "idempotency_key",
        F.lit("denied").alias("decision"),
        (F.col("occurred_at") + F.expr("interval 30 minutes")).alias("decided_at"),
    )
    last = txns.select(
        "idempotency_key",
        F.when(F.col("amount_cents") < 5000, F.lit("approved"))
        .otherwise(F.lit("denied"))
        .alias("decision"),
        (F.col("occurred_at") + F.expr("interval 1 hour")).alias("decided_at"),
    )
    return last.unionByName(first)


def fixed_score(key: Column) -> Column:
    """A stand-in model score from the digits of the event id, NULL for every fifth value."""
    digits = F.pmod(F.split_part(key, F.lit(":"), F.lit(2)).cast("bigint"), F.lit(100))
    return F.when(F.pmod(digits, F.lit(5)) != 0, digits / F.lit(100.0))


def scored_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(event_transactions(spark, sf_dir), DAY)


def flag_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags on all events, reviewed and partly scored."""
    flags = as_new_flags(scored_flags(spark, sf_dir), instant(CUTOFF))
    reviewed = review(flags, decisions(spark, sf_dir))
    return reviewed.withColumn("ml_score", fixed_score(F.col("idempotency_key"))).select(
        *FLAG_COLUMNS
    )


def earlier_flag_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviewed flag table as it stood at the cutoff."""
    before = event_transactions(spark, sf_dir).filter(F.col("occurred_at") < instant(CUTOFF))
    flags = as_new_flags(score(before, DAY), instant(CUTOFF))
    reviewed = review(flags, decisions(spark, sf_dir))
    return reviewed.withColumn("ml_score", fixed_score(F.col("idempotency_key"))).select(
        *FLAG_COLUMNS
    )


def type_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events on five accounts, one per event type: a fifth of the table each."""
    return keyed_events(spark, sf_dir).select(
        "idempotency_key",
        F.col("merchant_name").alias("account_id"),
        "amount_cents",
        F.col("k").cast("string").alias("merchant_category"),
        "city",
        "occurred_at",
        F.lit(0).alias("rule_flag_count"),
    )
