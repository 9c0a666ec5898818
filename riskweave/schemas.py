"""Table and feed schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_str, _long, _ts = T.StringType(), T.LongType(), T.TimestampType()


def _fields(*specs: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in specs])


TXN = _fields(
    ("idempotency_key", _str, False),
    ("bank", _str, False),
    ("native_id", _str, False),
    ("account_id", _str, False),
    ("amount_cents", _long, False),
    ("currency", _str, False),
    ("merchant_name", _str, False),
    ("merchant_category", _str, False),
    ("city", _str, True),
    ("occurred_at", _ts, False),
    ("ingested_at", _ts, False),
    ("raw", _str, True),
)

# The columns the rules read; everything else is pruned at the scan.
RULE_INPUT = (
    "idempotency_key",
    "account_id",
    "amount_cents",
    "merchant_category",
    "city",
    "occurred_at",
)

FLAG = _fields(
    ("idempotency_key", _str, False),
    ("account_id", _str, False),
    ("amount_cents", _long, False),
    ("merchant_category", _str, False),
    ("reasons", _str, False),
    ("occurred_at", _ts, False),
    ("status", _str, False),
    ("ml_score", T.DoubleType(), True),
    ("created_at", _ts, False),
    ("updated_at", _ts, False),
)

QUARANTINE = _fields(
    ("body", _str, True),
    ("message_id", _str, True),
    ("retry_count", T.IntegerType(), True),
    ("reason", _str, False),
)

ENVELOPE = _fields(
    ("body", _str, True),
    ("retry_count", T.IntegerType(), True),
    ("message_id", _str, True),
)

DECISION = _fields(
    ("idempotency_key", _str, False),
    ("decision", _str, False),
    ("decided_at", _ts, False),
)
