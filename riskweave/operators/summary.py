"""What must be known of an account's past to judge its next rows.

A summary is two tables that only add up:

``counts``   rows per account and merchant category
``recent``   the rows inside the look-back window of the account's last row

Summaries of two sets of rows are merged by stacking them, in any order and any number of
parts; ``merged`` brings them back to their shortest form. They give the count, the last row,
the categories used and the times in the window, which is all that the rules ask of the past
when every new row is later than the rows before. No row of a summary holds a list, so an
account with a dense window is many short rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.constants import CHUNK_ROWS, HEAVY_ACCOUNT_ROWS
from riskweave.operators.history import MICROS, with_history
from riskweave.operators.skew import null_safe_join
from riskweave.schemas import RULE_INPUT, TXN

COUNTS = T.StructType(
    [TXN["account_id"], TXN["merchant_category"], T.StructField("n", T.LongType())]
)


@dataclass(frozen=True)
class Summary:
    counts: DataFrame
    recent: DataFrame

    def map(self, change) -> Summary:
        return Summary(change(self.counts), change(self.recent))

    def plus(self, other: Summary) -> Summary:
        """The two stacked: a summary of both, not in its shortest form."""
        return Summary(
            self.counts.unionByName(other.counts), self.recent.unionByName(other.recent)
        )


def last_times(rows: DataFrame) -> DataFrame:
    """(account_id, last_us) of rows or of the ``recent`` part of a summary."""
    return rows.groupBy("account_id").agg(F.max(F.unix_micros("occurred_at")).alias("last_us"))


def summarize(txns: DataFrame, window_seconds: int) -> Summary:
    """The summary of some rows."""
    rows = txns.select(*RULE_INPUT)
    counts = rows.groupBy("account_id", "merchant_category").agg(F.count(F.lit(1)).alias("n"))
    return Summary(counts, in_last_window(rows, window_seconds))


def merged(summary: Summary, window_seconds: int) -> Summary:
    """One row per account and category, and only rows inside the last window."""
    return Summary(summed_counts(summary.counts), in_last_window(summary.recent, window_seconds))


def summed_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("account_id", "merchant_category").agg(F.sum("n").alias("n"))


def in_last_window(rows: DataFrame, window_seconds: int) -> DataFrame:
    """Rows not older than the window before their account's last row.

    The join is left to adaptive execution: it broadcasts the last times if they turn out
    short, and splits the partition of a heavy account if not.
    """
    placed = null_safe_join(rows, last_times(rows), "account_id", "inner")
    kept = F.unix_micros("occurred_at") >= F.col("last_us") - window_seconds * MICROS
    return placed.filter(kept).select(*RULE_INPUT)


def with_history_after(
    new: DataFrame,
    past: Summary,
    window_seconds: int,
    *,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``with_history`` of ``new`` rows whose accounts' past is known by its summary.

    Every row of ``new`` must be later than the last row of its account in ``past``; see
    ``last_times``. Accounts without new rows may be in ``past``. What is sorted are the new
    rows and the recent ones, however long the past is.
    """
    rows = new.withColumn("__new", F.lit(True))
    before = past.recent.withColumn("__new", F.lit(False))
    seen = with_history(
        rows.unionByName(before, allowMissingColumns=True),
        window_seconds,
        heavy_rows=heavy_rows,
        chunk_rows=chunk_rows,
    ).filter("__new")
    # Rows of the past that are not among the recent ones, which have positions already.
    older = (
        past.counts.select("account_id", "n")
        .unionByName(past.recent.select("account_id", F.lit(-1).cast("bigint").alias("n")))
        .groupBy("account_id")
        .agg(F.sum("n").alias("__older"))
    )
    used = past.counts.select("account_id", "merchant_category").distinct()
    placed = null_safe_join(seen, older, "account_id")
    placed = null_safe_join(
        placed, used.withColumn("__used", F.lit(True)), ["account_id", "merchant_category"]
    )
    return placed.select(
        *new.columns,
        "us",
        (F.coalesce("__older", F.lit(0)) + F.col("position")).alias("position"),
        "in_window",
        (F.col("first_use") & F.col("__used").isNull()).alias("first_use"),
        "prev_city",
        "prev_us",
    )
