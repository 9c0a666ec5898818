"""The flag table: upsert, review and presentation.

All operators are pure functions of frames; ``sources/tables.py`` and the streams
write their results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.constants import (
    DEFAULT_STATUS,
    HIGH_RISK_PERCENT,
    MEDIUM_RISK_PERCENT,
    STATUSES,
)
from riskweave.functions import dollars_text, reason_count, reason_list, reasons_display
from riskweave.operators.dedupe import dedupe_first
from riskweave.operators.validate import status_filter, status_or_default
from riskweave.schemas import FLAG

FLAG_COLUMNS = tuple(FLAG.fieldNames())


def as_new_flags(scored: DataFrame, as_of: Column, *more: str) -> DataFrame:
    """Scored rows as fresh ``pending`` flags, with ``more`` of their columns."""
    now = as_of.cast("timestamp")
    return scored.select(
        "idempotency_key",
        "account_id",
        "amount_cents",
        "merchant_category",
        "reasons",
        "occurred_at",
        F.lit(DEFAULT_STATUS).alias("status"),
        F.lit(None).cast("double").alias("ml_score"),
        now.alias("created_at"),
        now.alias("updated_at"),
        *more,
    )


def upsert_flags(current: DataFrame, scored: DataFrame, as_of: Column) -> DataFrame:
    """The flag table after a scoring pass.

    New keys come in as pending. A known key takes only the new reasons and update
    time, so a reviewer's decision and the model score stay. A flag that no longer
    fires is kept. Both sides are unique by key.
    """
    incoming = as_new_flags(scored, as_of)
    merged = current.select(*FLAG_COLUMNS).alias("old").join(
        incoming.alias("new"),
        F.col("old.idempotency_key") == F.col("new.idempotency_key"),
        "full_outer",
    )
    refreshed = ("reasons", "updated_at")
    columns = [
        F.coalesce(f"new.{c}", f"old.{c}") if c in refreshed else F.coalesce(f"old.{c}", f"new.{c}")
        for c in FLAG_COLUMNS
    ]
    return merged.select(*[e.alias(c) for e, c in zip(columns, FLAG_COLUMNS, strict=True)])


def new_flags(current: DataFrame, scored: DataFrame) -> DataFrame:
    """Scored rows whose key is not yet in the flag table: the change feed."""
    return scored.join(current.select("idempotency_key"), "idempotency_key", "left_anti")


def review(current: DataFrame, decisions: DataFrame) -> DataFrame:
    """Apply reviewers' decisions; the latest one per key wins.

    A decision may change any present status. Decisions on unknown keys are
    ignored, and a decision that is not ``approved`` or ``denied`` is an error.
    """
    allowed = F.col("decision").isin(*[s for s in STATUSES if s != DEFAULT_STATUS])
    checked = F.when(allowed, F.col("decision")).otherwise(
        F.raise_error(F.concat(F.lit("unknown decision: "), F.col("decision"))).cast("string")
    )
    latest = dedupe_first(decisions, F.desc("decided_at"), F.desc("decision")).select(
        "idempotency_key", checked.alias("decision"), "decided_at"
    )
    return current.join(latest, "idempotency_key", "left").select(
        *[
            F.coalesce("decision", "status").alias(c)
            if c == "status"
            else F.greatest("decided_at", "updated_at").alias(c)
            if c == "updated_at"
            else F.col(c)
            for c in FLAG_COLUMNS
        ]
    )


def review_queue(flags: DataFrame, status: str | None = None, limit: int | None = None) -> DataFrame:
    """Flags of one status, newest first; the key makes the order total.

    A total order lets the range-partitioned sort split an instant that many flags
    share. ``limit`` is for a page of the report.
    """
    queue = status_filter(flags, status).orderBy(F.desc("occurred_at"), "idempotency_key")
    return queue if limit is None else queue.limit(limit)


def flag_by_key(flags: DataFrame, key: str) -> DataFrame:
    """One flag; reads one bucket when the table is stored by key bucket."""
    return flags.filter(F.col("idempotency_key") == key)


def ml_score_percent(score: Column) -> Column:
    return F.round(score * F.lit(100.0), 1)


def risk_band(score: Column) -> Column:
    percent = ml_score_percent(score)
    return (
        F.when(percent >= HIGH_RISK_PERCENT, F.lit("high"))
        .when(percent >= MEDIUM_RISK_PERCENT, F.lit("medium"))
        .when(percent.isNotNull(), F.lit("low"))
        .otherwise(F.lit("unscored"))
    )


def score_text(score: Column) -> Column:
    percent = ml_score_percent(score)
    return F.when(percent.isNotNull(), F.format_string("%.1f%%", percent)).otherwise(
        F.lit("scoring…")
    )


def presentation(flags: DataFrame) -> DataFrame:
    """The columns a reviewer sees."""
    return flags.select(
        "idempotency_key",
        "account_id",
        dollars_text(F.col("amount_cents")).alias("amount"),
        "merchant_category",
        reason_list(F.col("reasons")).alias("reason_list"),
        reasons_display(F.col("reasons")).alias("reasons_text"),
        score_text(F.col("ml_score")).alias("ml_risk"),
        risk_band(F.col("ml_score")).alias("risk_band"),
        F.date_format("occurred_at", "MMM d, HH:mm:ss").alias("occurred_text"),
        "status",
    )


def with_rule_flag_count(txns: DataFrame, flags: DataFrame) -> DataFrame:
    """Transactions with the number of rules that fired on them, 0 without a flag."""
    counts = flags.select(
        "idempotency_key", reason_count(F.col("reasons")).alias("rule_flag_count")
    )
    return txns.join(counts, "idempotency_key", "left").withColumn(
        "rule_flag_count", F.coalesce("rule_flag_count", F.lit(0))
    )


def status_counts(flags: DataFrame) -> DataFrame:
    """Flags per status, 0 for a status that does not occur; one pass, one row shuffled per task."""
    totals = flags.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    return totals.select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES]))
    )


def flags_by_rule(flags: DataFrame) -> DataFrame:
    """Number of flags raised by each rule; a flag with two reasons counts for both."""
    reason = F.explode(reason_list(F.col("reasons"))).alias("reason")
    return (
        flags.select(reason)
        .groupBy(F.split_part("reason", F.lit(":"), F.lit(1)).alias("rule"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


__all__ = [
    "FLAG_COLUMNS",
    "as_new_flags",
    "flag_by_key",
    "flags_by_rule",
    "ml_score_percent",
    "new_flags",
    "presentation",
    "review",
    "review_queue",
    "risk_band",
    "score_text",
    "status_counts",
    "status_filter",
    "status_or_default",
    "upsert_flags",
    "with_rule_flag_count",
]
