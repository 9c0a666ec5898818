"""Column expressions; everything here stays inside the JVM."""

from riskweave.functions.geo import city_table, haversine_km, with_coordinates
from riskweave.functions.money import amount_dollars, dollars_to_cents, dollars_text
from riskweave.functions.report import percent_text
from riskweave.functions.text import (
    idempotency_key,
    json_text,
    parsed_once,
    reason_count,
    reason_list,
    reasons_display,
    text_or_empty,
)
from riskweave.functions.times import micros, parse_rfc3339, rfc3339_text, seconds_floor

__all__ = [
    "amount_dollars",
    "city_table",
    "dollars_text",
    "dollars_to_cents",
    "haversine_km",
    "idempotency_key",
    "json_text",
    "micros",
    "parse_rfc3339",
    "parsed_once",
    "percent_text",
    "reason_count",
    "reason_list",
    "reasons_display",
    "rfc3339_text",
    "seconds_floor",
    "text_or_empty",
    "with_coordinates",
]
