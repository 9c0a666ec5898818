"""Model features; one code path for training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.constants import (
    ATTACK_BANK,
    CHUNK_ROWS,
    FEATURE_COLUMNS,
    HEAVY_ACCOUNT_ROWS,
    HIGH_RISK_CATEGORY,
    ZERO_GAP_SPEED_FACTOR,
    RuleSettings,
)
from riskweave.functions.times import hour_of_day, weekday
from riskweave.operators.history import MICROS, with_history, with_history_since
from riskweave.operators.rules import with_distance

FEATURE_INPUT = (
    "idempotency_key",
    "account_id",
    "amount_cents",
    "merchant_category",
    "city",
    "occurred_at",
    "rule_flag_count",
)


def with_label(txns: DataFrame, attack_bank: str = ATTACK_BANK) -> DataFrame:
    return txns.withColumn("label", (F.col("bank") == attack_bank).cast("double"))


def build_features(
    txns: DataFrame,
    *,
    settings: RuleSettings | None = None,
    high_risk_category: str = HIGH_RISK_CATEGORY,
    cities: DataFrame | None = None,
    since: DataFrame | None = None,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the eight feature columns to transactions that carry ``rule_flag_count``.

    ``velocity_count`` works on whole seconds and leaves the row itself out, and
    ``geo_speed_kmh`` on fractional seconds: both differ from the rules on purpose.
    With ``since``, ``(account_id, since_us)``, only rows from that time on of those
    accounts get features, still drawn from the whole history in ``txns``.
    """
    settings = settings or RuleSettings()
    keep = [*FEATURE_INPUT, *[c for c in ("label",) if c in txns.columns]]
    how = {"whole_seconds": True, "heavy_rows": heavy_rows, "chunk_rows": chunk_rows}
    seen, window = txns.select(*keep), settings.window_seconds
    if since is None:
        history = with_history(seen, window, **how)
    else:
        history = with_history_since(seen, since, window, **how)
    history = with_distance(history, cities)
    hours = (F.col("us") - F.col("prev_us")) / F.lit(3600.0 * MICROS)
    speed = F.when(hours > 0, F.try_divide(F.col("km"), hours)).otherwise(
        F.col("km") * F.lit(ZERO_GAP_SPEED_FACTOR)
    )
    measured = F.when(F.col("km") >= settings.min_km, speed).otherwise(F.lit(0.0))
    return history.select(
        *keep,
        hour_of_day(F.col("us")).alias("hour_of_day"),
        weekday(F.col("us")).alias("weekday"),
        (F.col("merchant_category") == high_risk_category).cast("int").alias("is_high_risk_mcc"),
        (F.col("in_window") - 1).alias("velocity_count"),
        (~F.col("first_use")).cast("int").alias("category_seen_before"),
        measured.alias("geo_speed_kmh"),
    ).select(*[c for c in keep if c not in FEATURE_COLUMNS], *FEATURE_COLUMNS)
