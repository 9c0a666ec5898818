"""Transactions as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.constants import BAD_TIMESTAMP_ERROR, UNMARSHAL_PREFIX
from riskweave.functions import (
    idempotency_key,
    parse_rfc3339,
    parsed_once,
    rfc3339_text,
    text_or_empty,
)

# Fixed field names of a message body.
TEXT_FIELDS = (
    "bank",
    "native_id",
    "account_id",
    "currency",
    "merchant_name",
    "merchant_category",
    "city",
    "timestamp",
)
# Every field keeps the type that its JSON has; ``raw`` is any document, as text.
BODY_SCHEMA = (
    "ARRAY<STRUCT<"
    + ", ".join(f"`{name}` VARIANT" for name in (*TEXT_FIELDS, "amount_cents"))
    + ", `raw` STRING>>"
)


def to_envelope(txns: DataFrame) -> DataFrame:
    """Message body, retry count 0 and the key as message id."""
    body = F.to_json(
        F.struct(
            "bank",
            "native_id",
            "account_id",
            "amount_cents",
            "currency",
            "merchant_name",
            "merchant_category",
            text_or_empty(F.col("city")).alias("city"),
            rfc3339_text(F.col("occurred_at")).alias("timestamp"),
            F.try_parse_json("raw").alias("raw"),
        )
    )
    return txns.select(
        body.alias("body"),
        F.lit(0).alias("retry_count"),
        F.col("idempotency_key").alias("message_id"),
    )


def _documents(body: Column) -> Column:
    """The body as an array, of one element if it is one strict JSON object.

    Text after the object, or a second object, makes the array malformed or longer.
    """
    return F.from_json(
        F.concat(F.lit("["), body, F.lit("]")), BODY_SCHEMA, {"allowSingleQuotes": "false"}
    )


def parse_envelope(messages: DataFrame, as_of: Column) -> DataFrame:
    """Messages as unified transactions plus ``body``, ``message_id``, ``retry_count``, ``error``.

    ``error`` starts with ``unmarshal error: `` for a body that is not one strict JSON
    object, has a field of the wrong JSON type, or a bad timestamp. A missing text field is
    empty; a missing timestamp is an error. A body is parsed once, and each field's type, text
    and time are found once.
    """
    kept = ("body", "message_id", "retry_count")
    parsed = messages.select(*kept, parsed_once(_documents(F.col("body"))).alias("d")).select(
        *kept, F.when(F.size("d") == 1, F.col("d")[0]).alias("m")
    )

    # The type of a field takes longer to find than its text, and both are mentioned often.
    def kind(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.col(f"m.{name}")), F.lit("VOID")).alias(name)

    def text(name: str) -> Column:
        value = F.variant_get(F.col(f"m.{name}"), "$", "string")
        return F.coalesce(F.when(F.col(f"k.{name}") == "STRING", value), F.lit("")).alias(name)

    kinds = F.struct(*[kind(n) for n in (*TEXT_FIELDS, "amount_cents")])
    parsed = parsed.select(*kept, "m", parsed_once(kinds).alias("k"))
    parsed = parsed.select(*kept, "m", "k", parsed_once(F.struct(*[text(n) for n in TEXT_FIELDS])).alias("t"))
    parsed = parsed.select("*", parsed_once(parse_rfc3339(F.col("t.timestamp"))).alias("occurred_at"))
    wrong = F.concat_ws(
        ", ", *[F.when(~F.col(f"k.{n}").isin("STRING", "VOID"), F.lit(n)) for n in TEXT_FIELDS]
    )
    problem = (
        F.when(
            F.col("m").isNull() | ~F.col("k.amount_cents").isin("BIGINT", "VOID"),
            F.lit("malformed body"),
        )
        .when(wrong != "", F.concat(F.lit("not a string: "), wrong))
        .when(F.col("occurred_at").isNull(), F.lit(BAD_TIMESTAMP_ERROR))
    )
    cents = F.try_variant_get(F.col("m.amount_cents"), "$", "bigint")
    return parsed.select(
        idempotency_key(F.col("t.bank"), F.col("t.native_id")).alias("idempotency_key"),
        *[F.col(f"t.{name}") for name in ("bank", "native_id", "account_id")],
        F.coalesce(cents, F.lit(0)).alias("amount_cents"),
        *[F.col(f"t.{name}") for name in ("currency", "merchant_name", "merchant_category", "city")],
        "occurred_at",
        as_of.cast("timestamp").alias("ingested_at"),
        F.col("m.raw").alias("raw"),
        "body",
        "message_id",
        "retry_count",
        F.concat(F.lit(UNMARSHAL_PREFIX), problem).alias("error"),
    )


def unparseable(parsed: DataFrame) -> DataFrame:
    """Quarantine rows of ``parse_envelope`` output; a broken body is never retried."""
    return parsed.filter(F.col("error").startswith(UNMARSHAL_PREFIX)).select(
        "body", "message_id", "retry_count", F.col("error").alias("reason")
    )
