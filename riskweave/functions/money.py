"""Money is integer cents everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars_to_cents(dollars: Column, rounding: str = "truncate") -> Column:
    """Cents of a double dollar amount.

    ``truncate`` drops the fraction of the binary product, so 19.99 is 1998;
    ``half_up`` rounds it and gives 1999. An amount beyond 64 bits, or not a number,
    is NULL instead of an error that would stop the job.
    """
    cents = dollars * F.lit(100.0)
    if rounding == "half_up":
        cents = F.round(cents)
    elif rounding != "truncate":
        raise ValueError(f"rounding must be 'truncate' or 'half_up', not {rounding!r}")
    return cents.try_cast("bigint")


def amount_dollars(cents: Column) -> Column:
    return cents / F.lit(100.0)


def dollars_text(cents: Column) -> Column:
    return F.format_string("$%.2f", amount_dollars(cents))
