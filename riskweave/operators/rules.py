"""The three backward-looking rules and their assembly into flags.

A rule is a function from settings to a Column that is NULL when the rule is silent
and the reason text when it fires. ``score`` takes any sequence of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.constants import (
    CHUNK_ROWS,
    HEAVY_ACCOUNT_ROWS,
    REASON_SEPARATOR,
    RuleSettings,
)
from riskweave.functions import haversine_km, seconds_floor, with_coordinates
from riskweave.operators.history import with_history, with_history_since
from riskweave.operators.summary import Summary, with_history_after
from riskweave.schemas import RULE_INPUT

Rule = Callable[[RuleSettings], Column]


def velocity(settings: RuleSettings) -> Column:
    """Too many rows in too short a window."""
    n = F.col("in_window")
    text = F.format_string(f"velocity: %d transactions within {settings.window_seconds}s", n)
    return F.when(n >= settings.velocity_threshold, text)


def mcc_drift(settings: RuleSettings) -> Column:
    """First use of a category by an account with enough history."""
    fires = (F.col("position") > settings.min_history) & F.col("first_use")
    return F.when(
        fires,
        F.concat(
            F.lit("mcc_drift: first time this account has used category "),
            F.col("merchant_category"),
        ),
    )


def geo_impossible(settings: RuleSettings) -> Column:
    """The move from the row just before is faster than a flight.

    Elapsed time is the difference of whole seconds. Unknown cities cannot be
    measured and never fire.
    """
    km = F.col("km")
    hours = F.abs(seconds_floor(F.col("us")) - seconds_floor(F.col("prev_us"))) / F.lit(3600.0)
    kmh = F.try_divide(km, hours)
    trip = F.concat(
        F.lit("geo_impossible: "),
        F.col("prev_city"),
        F.lit(" -> "),
        F.col("city"),
        F.lit(" implies traveling "),
    )
    far = km >= settings.min_km
    return F.when(far & (hours <= 0), F.concat(trip, F.lit("instantaneously"))).when(
        far & (kmh > settings.max_kmh),
        F.concat(trip, F.round(kmh).cast("bigint").cast("string"), F.lit(" km/h")),
    )


# The order in which reasons are listed.
RULES: tuple[Rule, ...] = (velocity, mcc_drift, geo_impossible)


def with_distance(history: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """Add ``km`` from the previous row's city; NULL if either city is unknown."""
    located = with_coordinates(history, "city", "lat", "lon", cities)
    located = with_coordinates(located, "prev_city", "prev_lat", "prev_lon", cities)
    km = haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    return located.withColumn("km", km).drop("lat", "lon", "prev_lat", "prev_lon")


def score(
    txns: DataFrame,
    settings: RuleSettings | None = None,
    *,
    rules: Sequence[Rule] = RULES,
    cities: DataFrame | None = None,
    since: DataFrame | None = None,
    past: Summary | None = None,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Transactions that trip at least one rule, with ``flags`` and ``reasons``.

    With ``since``, ``(account_id, since_us)``, only the rows from that time on of those
    accounts are judged, against the whole history in ``txns``. The rules look back, so
    new rows cannot change the judgement of rows before them.

    With ``past``, the rows in ``txns`` are judged against a summary of all rows before them;
    every one must be later than its account's last row there.
    """
    settings = settings or RuleSettings()
    limits = {"heavy_rows": heavy_rows, "chunk_rows": chunk_rows}
    seen, window = txns.select(*RULE_INPUT), settings.window_seconds
    if past is not None:
        history = with_history_after(seen, past, window, **limits)
    elif since is None:
        history = with_history(seen, window, **limits)
    else:
        history = with_history_since(seen, since, window, **limits)
    return judge(history, settings, rules=rules, cities=cities)


def judge(
    history: DataFrame,
    settings: RuleSettings,
    *,
    rules: Sequence[Rule] = RULES,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Rows with history that trip at least one rule; no row sees another here."""
    # The generator computes every reason once per row. Without it the filter would be
    # pushed down with copies of the reason and distance expressions in it.
    names = [f"__reason_{i}" for i in range(len(rules))]
    reasons = F.struct(*[rule(settings).alias(n) for n, rule in zip(names, rules, strict=True)])
    judged = with_distance(history, cities).select(*RULE_INPUT, F.inline(F.array(reasons)))
    return judged.filter(reduce(or_, [F.col(n).isNotNull() for n in names])).select(
        "idempotency_key",
        "account_id",
        "amount_cents",
        "merchant_category",
        "city",
        "occurred_at",
        F.array_compact(F.array(*names)).alias("flags"),
        F.concat_ws(REASON_SEPARATOR, *names).alias("reasons"),
    )
