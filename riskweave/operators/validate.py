"""Validation, retry routing, outcome tallies and flag-table constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.constants import (
    BAD_TIMESTAMP_ERROR,
    DEFAULT_STATUS,
    GAVE_UP_TEXT,
    MAX_RETRIES,
    MISSING_ID_ERROR,
    RETRY_DELAY_SECONDS,
    STATUSES,
    ZERO_AMOUNT_ERROR,
)
from riskweave.operators.skew import in_tasks


def validation_error() -> Column:
    """Why a transaction is rejected, or NULL. Identity is checked before amount."""
    return (
        F.when((F.col("bank") == "") | (F.col("native_id") == ""), F.lit(MISSING_ID_ERROR))
        .when(
            F.col("amount_cents") == 0,
            F.format_string(ZERO_AMOUNT_ERROR, F.col("idempotency_key")),
        )
        .when(F.col("occurred_at").isNull(), F.lit(BAD_TIMESTAMP_ERROR))
    )


def validate(txns: DataFrame) -> DataFrame:
    """Set ``error`` on rows to reject; an ``error`` from an earlier step wins.

    Negative amounts and empty account ids pass. Rejection does not depend on
    other rows, so it must run before deduplication: an invalid row never hides a
    valid one with its key.
    """
    found = validation_error()
    if "error" in txns.columns:
        found = F.coalesce(F.col("error"), found)
    return txns.withColumn("error", found)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("error").isNull()).drop("error")


def gave_up_reason(retry_count: Column, error: Column) -> Column:
    return F.format_string(GAVE_UP_TEXT, retry_count, error)


def rejected(validated: DataFrame, body: Column | None = None) -> DataFrame:
    """Invalid rows as quarantine rows.

    A retry cannot help a row that is invalid by itself, so it is quarantined at
    once with the text it would have after its retries; its count stays 0.
    """
    content = F.col("raw") if body is None else body
    return validated.filter(F.col("error").isNotNull()).select(
        content.alias("body"),
        F.col("idempotency_key").alias("message_id"),
        F.lit(0).alias("retry_count"),
        gave_up_reason(F.lit(MAX_RETRIES), F.col("error")).alias("reason"),
    )


def route_failures(
    failed: DataFrame,
    *,
    as_of: Column,
    max_retries: int = MAX_RETRIES,
    delay_seconds: int = RETRY_DELAY_SECONDS,
) -> DataFrame:
    """Where a failed delivery goes next.

    Adds ``route`` (``retry`` or ``dead``), the next ``retry_count``,
    ``available_at`` for a retry and ``reason`` for a dead letter. With the
    defaults a delivery is tried at most four times.
    """
    count = F.coalesce(F.col("retry_count"), F.lit(0))
    dead = count >= max_retries
    due = as_of.cast("timestamp") + F.make_dt_interval(secs=F.lit(delay_seconds))
    return failed.withColumns(
        {
            "route": F.when(dead, F.lit("dead")).otherwise(F.lit("retry")),
            "retry_count": F.when(dead, count).otherwise(count + 1).cast("int"),
            "available_at": F.when(~dead, due),
            "reason": F.when(dead, gave_up_reason(count, F.col("error"))),
        }
    )


def retries(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == "retry").drop("route", "reason")


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == "dead").select(
        "body", "message_id", "retry_count", "reason"
    )


def outcome_tally(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def status_or_default(status: str | None) -> str:
    return status if status in STATUSES else DEFAULT_STATUS


def status_filter(flags: DataFrame, status: str | None) -> DataFrame:
    """Flags of one status; an unknown status means pending."""
    return flags.filter(F.col("status") == status_or_default(status))


def flag_violations(flags: DataFrame) -> DataFrame:
    """Constraint breaches, one row per broken rule and key.

    One pass: the rows of a key are counted and their marks joined, with a bit per rule. Keys
    are nearly unique, so a task holds about as many groups as it has rows; the tasks are as
    many as the rows need, and copies of one key, two small columns wide, only add to its
    group. ``flags`` is read twice, the first time to count.
    """
    checks = {
        "idempotency_key missing": F.coalesce(F.trim("idempotency_key"), F.lit("")) == "",
        "account_id missing": F.coalesce(F.trim("account_id"), F.lit("")) == "",
        "amount_cents missing": F.col("amount_cents").isNull(),
        "merchant_category missing": F.coalesce(F.trim("merchant_category"), F.lit("")) == "",
        "occurred_at missing": F.col("occurred_at").isNull(),
        "status not allowed": ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)),
    }
    bit = [F.when(broken, F.lit(1 << k)).otherwise(F.lit(0)) for k, broken in enumerate(checks.values())]
    marked = flags.select("idempotency_key", reduce(Column.bitwiseOR, bit).alias("broken"))
    per_key = (
        in_tasks(marked, flags.count(), "idempotency_key")
        .groupBy("idempotency_key")
        .agg(F.bit_or("broken").alias("broken"), F.count(F.lit(1)).alias("n"))
    )
    found = [F.when(F.col("broken").bitwiseAND(1 << k) != 0, F.lit(text)) for k, text in enumerate(checks)]
    repeated = (F.col("n") > 1) & F.col("idempotency_key").isNotNull()
    found.append(F.when(repeated, F.lit("idempotency_key not unique")))
    return per_key.select(
        "idempotency_key", F.explode(F.array_compact(F.array(*found))).alias("violation")
    )


def require_columns(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Pass ``df`` on if it has every expected column with its type, else fail."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = {c: t for c, t in expected.items() if actual.get(c) != t}
    if wrong:
        have = {c: actual.get(c) for c in wrong}
        raise ValueError(f"columns missing or of another type: expected {wrong}, found {have}")
    return df


def add_missing_columns(df: DataFrame, additive: dict[str, str]) -> DataFrame:
    """Back-fill nullable columns that older files do not have."""
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in additive.items() if c not in df.columns}
    )
