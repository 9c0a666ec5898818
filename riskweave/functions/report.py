"""Report formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(ratio: Column, decimals: int = 1) -> Column:
    """A ratio as a percentage text; ``n/a`` when it is undefined."""
    text = F.format_string(f"%.{decimals}f%%", ratio * F.lit(100.0))
    return F.when(ratio.isNotNull(), text).otherwise(F.lit("n/a"))
