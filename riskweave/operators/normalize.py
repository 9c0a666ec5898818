"""Native feed rows to the unified transaction schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.constants import BAD_AMOUNT_ERROR, BAD_TIMESTAMP_ERROR, CURRENCY
from riskweave.functions import (
    dollars_to_cents,
    idempotency_key,
    json_text,
    parse_rfc3339,
    text_or_empty,
)
from riskweave.sources.feeds import FEEDS, MISFIT, Feed

ORDER_COLUMNS = ("page_no", "pos")


def _text(name: str) -> Column:
    return text_or_empty(json_text(F.col(name)))


def normalize_feed(
    native: DataFrame,
    feed: Feed,
    *,
    as_of: Column,
    rounding: str = "truncate",
    on_error: str = "quarantine",
) -> DataFrame:
    """One feed in the unified schema, plus ``error`` (NULL for a good row).

    Missing or non-text strings become ``''`` and a missing or non-numeric amount
    0, which validation rejects later. A bad timestamp sets ``error``, or aborts
    the job when ``on_error`` is ``fail``; an amount out of range sets ``error``.
    ``raw`` is the native row, in its original text if it did not fit the schema.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    amount = F.coalesce(F.col(feed.amount), F.lit(0.0))
    if feed.amount_in_dollars:
        cents = dollars_to_cents(amount, rounding)
    else:
        cents = amount.try_cast("bigint")
    occurred_at = parse_rfc3339(json_text(F.col(feed.occurred_at)))
    error = F.when(occurred_at.isNull(), F.lit(BAD_TIMESTAMP_ERROR))
    if on_error == "fail":
        error = F.when(
            occurred_at.isNull(), F.raise_error(F.lit(f"{feed.bank}: {BAD_TIMESTAMP_ERROR}"))
        ).cast("string")
    error = F.coalesce(error, F.when(cents.isNull(), F.lit(BAD_AMOUNT_ERROR)))
    native_id = _text(feed.native_id)
    native_columns = [*feed.text_fields, feed.amount, *feed.extra]
    raw = F.to_json(F.struct(*native_columns))
    if MISFIT in native.columns:
        raw = F.coalesce(F.col(MISFIT), raw)
    return native.select(
        *[c for c in ORDER_COLUMNS if c in native.columns],
        idempotency_key(F.lit(feed.bank), native_id).alias("idempotency_key"),
        F.lit(feed.bank).alias("bank"),
        native_id.alias("native_id"),
        _text(feed.account_id).alias("account_id"),
        cents.alias("amount_cents"),
        F.lit(CURRENCY).alias("currency"),
        _text(feed.merchant_name).alias("merchant_name"),
        _text(feed.merchant_category).alias("merchant_category"),
        _text(feed.city).alias("city"),
        occurred_at.alias("occurred_at"),
        as_of.cast("timestamp").alias("ingested_at"),
        raw.alias("raw"),
        error.alias("error"),
    )


def union_feeds(
    natives: Mapping[str, DataFrame],
    *,
    as_of: Column,
    feeds: Mapping[str, Feed] | None = None,
    rounding: str = "truncate",
    on_error: str = "quarantine",
) -> DataFrame:
    """All feeds in one flow; a further feed is one more ``Feed`` entry."""
    known = FEEDS if feeds is None else feeds
    parts = [
        normalize_feed(native, known[bank], as_of=as_of, rounding=rounding, on_error=on_error)
        for bank, native in natives.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def feed_counts(checked: DataFrame) -> DataFrame:
    """Rows fetched and published (those without ``error``) per bank, with a ``total`` row.

    One pass, aggregated to one row per bank before the total is formed.
    """
    per_bank = checked.groupBy("bank").agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("error").isNull()).alias("published"),
    )
    return (
        per_bank.rollup("bank")
        .agg(
            F.sum("fetched").alias("fetched"),
            F.sum("published").alias("published"),
            F.grouping("bank").alias("__all"),
        )
        .select(
            F.when(F.col("__all") == 1, F.lit("total")).otherwise(F.col("bank")).alias("bank"),
            "fetched",
            "published",
        )
    )
