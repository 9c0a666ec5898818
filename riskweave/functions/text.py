"""Text expressions: keys, JSON strings, and the newline-joined reasons column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.constants import REASON_DISPLAY_SEPARATOR, REASON_SEPARATOR


def text_or_empty(value: Column) -> Column:
    """A missing string is the empty string, never NULL."""
    return F.coalesce(value, F.lit(""))


def json_text(value: Column) -> Column:
    """The text of a VARIANT holding a JSON string; NULL for any other JSON type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string"))


def parsed_once(value: Column) -> Column:
    """A parsed document that later filters cannot copy back into their conditions.

    Filters are pushed through projections by repeating the expression, which for a
    parser means parsing the text once per mention. They stop at a generator.
    """
    return F.explode(F.array(value))


def idempotency_key(bank: Column, native_id: Column) -> Column:
    return F.concat(bank, F.lit(":"), native_id)


def reason_list(reasons: Column) -> Column:
    """The non-blank reasons; NULL gives an empty array."""
    parts = F.split(text_or_empty(reasons), REASON_SEPARATOR)
    return F.filter(parts, lambda part: part.rlike(r"\S"))


def reason_count(reasons: Column) -> Column:
    """Number of newline-separated parts, blanks counted; 0 without a flag."""
    return F.coalesce(F.array_size(F.split(reasons, REASON_SEPARATOR)), F.lit(0))


def reasons_display(reasons: Column) -> Column:
    return F.array_join(reason_list(reasons), REASON_DISPLAY_SEPARATOR)
