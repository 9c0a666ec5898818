"""What each transaction can see of its account's past.

Rows of an account are totally ordered by ``(occurred_at, idempotency_key)``, and a
row sees only earlier rows. Rows that repeat both are ordered by category and city; a
category that such rows share is new to all of them. A NULL account is one account. Both the rules and the model features read the columns
added here:

``position``     1-based position in the account's history
``in_window``    rows inside the look-back window, this row included
``first_use``    whether the account uses this merchant category for the first time
``prev_city``    city of the row just before
``prev_us``      its time in epoch microseconds

Accounts up to a row limit share one hash shuffle on ``account_id``. Heavier
accounts (a card-testing target, or rows without an account) take a second route
that sorts by range and carries small per-chunk summaries across the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.constants import CHUNK_ROWS, HEAVY_ACCOUNT_ROWS
from riskweave.operators.skew import (
    CHUNK,
    before_chunk,
    join_short,
    null_safe_join,
    range_chunks,
    split_heavy,
)

MICROS = 1_000_000
ORDER = ("us", "idempotency_key", "merchant_category", "city")
HISTORY_COLUMNS = ("position", "in_window", "first_use", "prev_city", "prev_us")


def with_history(
    txns: DataFrame,
    window_seconds: int,
    *,
    whole_seconds: bool = False,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the history columns and ``us`` (epoch microseconds).

    The window reaches back ``window_seconds``, both ends included, at microsecond
    precision, or between times cut to whole seconds. Which route an account takes
    changes no result, also where keys repeat.
    """
    timed = txns.withColumn("us", F.unix_micros("occurred_at"))
    split = split_heavy(timed, "account_id", heavy_rows)
    result = _by_account(split.light, window_seconds, whole_seconds)
    if split.heavy is None:
        return result
    heavy = _by_range(split.heavy, window_seconds, whole_seconds, split.heavy_rows, chunk_rows)
    return result.unionByName(heavy)


def with_history_since(
    txns: DataFrame,
    since: DataFrame,
    window_seconds: int,
    *,
    whole_seconds: bool = False,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``with_history`` of the rows at or after ``since_us`` of their account only.

    ``since`` is one row ``(account_id, since_us)`` per account. What lies before the
    window of an account's first such row is not sorted but aggregated, map-side first:
    a count, the last row and the categories used. The rows that are sorted are as many
    as the new and the recent ones, however long the history is.
    """
    timed = txns.withColumn("us", F.unix_micros("occurred_at"))
    marked = join_short(timed, since, "account_id", "inner")
    # Cut to whole seconds, a window may begin up to a second earlier.
    reach = (window_seconds + int(whole_seconds)) * MICROS
    is_old = F.col("us") < F.col("since_us") - reach
    # One pass over the old rows; the rest derives from its short result.
    old = (
        marked.filter(is_old)
        .groupBy("account_id", "merchant_category")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.struct("us", "idempotency_key", "city")).alias("tail"),
        )
        .checkpoint()
    )
    per_account = old.groupBy("account_id").agg(
        F.sum("n").alias("rows_before"), F.max("tail").alias("tail_before")
    )
    used = old.select("account_id", "merchant_category")
    recent = with_history(
        marked.filter(~is_old),
        window_seconds,
        whole_seconds=whole_seconds,
        heavy_rows=heavy_rows,
        chunk_rows=chunk_rows,
    )
    wanted = recent.filter(F.col("us") >= F.col("since_us"))
    wanted = join_short(wanted, per_account, "account_id")
    wanted = join_short(
        wanted, used.withColumn("used", F.lit(True)), ["account_id", "merchant_category"]
    )
    alone = F.col("prev_us").isNull()
    return wanted.select(
        *timed.columns,
        (F.coalesce("rows_before", F.lit(0)) + F.col("position")).alias("position"),
        "in_window",
        (F.col("first_use") & F.col("used").isNull()).alias("first_use"),
        F.when(alone, F.col("tail_before.city")).otherwise(F.col("prev_city")).alias("prev_city"),
        F.when(alone, F.col("tail_before.us")).otherwise(F.col("prev_us")).alias("prev_us"),
    )


def _by_account(df: DataFrame, window_seconds: int, whole_seconds: bool) -> DataFrame:
    columns = df.columns
    if whole_seconds:
        # The same order with the frame's own key first, so that one sort serves both.
        df, reach = df.withColumn("__second", F.unix_seconds("occurred_at")), window_seconds
        order = ["__second", *ORDER]
    else:
        reach = window_seconds * MICROS
        order = list(ORDER)
    history = W.partitionBy("account_id").orderBy(*order)
    # The category is the partition, and peers differ in city only: the order leaves both out.
    category = W.partitionBy("account_id", "merchant_category").orderBy(*order[:-2])
    # What has left the window: a frame that only grows, so it costs one pass however
    # dense a burst is. It ends before the row's own instant, and so has no peers of it.
    gone = W.partitionBy("account_id").orderBy(order[0])
    gone = gone.rangeBetween(W.unboundedPreceding, -reach - 1)
    return (
        df.withColumn("position", F.row_number().over(history))
        .withColumn("prev_city", F.lag("city").over(history))
        .withColumn("prev_us", F.lag("us").over(history))
        .withColumn("in_window", F.col("position") - F.count(F.lit(1)).over(gone))
        .withColumn("first_use", F.dense_rank().over(category) == 1)
        .withColumns({c: F.col(c).cast("bigint") for c in ("position", "in_window")})
        .select(*columns, *HISTORY_COLUMNS)
    )


def _leaves_window(window_seconds: int, whole_seconds: bool) -> Column:
    """The last microsecond at which a new row still has this row in its window."""
    if whole_seconds:
        return (F.unix_seconds("occurred_at") + window_seconds + 1) * MICROS - 1
    return F.col("us") + window_seconds * MICROS


def _by_range(
    df: DataFrame, window_seconds: int, whole_seconds: bool, rows: int, chunk_rows: int
) -> DataFrame:
    """The same columns by sorted chunks; no task holds a whole account.

    Every row enters at its time and leaves when its window ends, after the rows of
    that instant. Entries minus leaves up to a row are the rows in its window, a
    running sum that costs the same however dense a burst is. Sums and last rows of a
    chunk are carried into the chunks after it.
    """
    payload = [c for c in df.columns if c not in ("account_id", "idempotency_key")]
    enters = df.select(
        "account_id",
        "idempotency_key",
        F.col("us").alias("__at"),
        F.lit(0).alias("__leaves"),
        *payload,
    )
    leaves = df.select(
        "account_id",
        "idempotency_key",
        _leaves_window(window_seconds, whole_seconds).alias("__at"),
        F.lit(1).alias("__leaves"),
    )
    sweep = ["__at", "__leaves", "idempotency_key", "merchant_category", "city"]
    chunks = range_chunks(
        enters.unionByName(leaves, allowMissingColumns=True),
        ["account_id", *sweep],
        2 * rows,
        chunk_rows,
    )
    is_row = F.col("__leaves") == 0
    entered = F.lit(1) - F.col("__leaves")
    inside = F.lit(1) - 2 * F.col("__leaves")
    row = F.when(is_row, F.struct(*sweep))

    # One row per account and chunk, a few per chunk in all.
    before = before_chunk("account_id")
    carried = (
        chunks.groupBy("account_id", CHUNK)
        .agg(
            F.sum(entered).alias("entered"),
            F.sum(inside).alias("inside"),
            F.max(row).alias("tail"),
        )
        .select(
            "account_id",
            CHUNK,
            F.coalesce(F.sum("entered").over(before), F.lit(0)).alias("entered_before"),
            F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("inside_before"),
            F.last("tail", True).over(before).alias("tail_before"),
        )
    )
    # The first row of each (account, category), from partial minima before the shuffle.
    first_use = (
        chunks.filter(is_row)
        .groupBy("account_id", "merchant_category")
        .agg(F.min(F.struct("__at", "idempotency_key")).alias("first"))
    )

    within = W.partitionBy("account_id", CHUNK).orderBy(*sweep)
    so_far = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = within.rowsBetween(W.unboundedPreceding, -1)
    summed = (
        chunks.withColumn("entered_here", F.sum(entered).over(so_far))
        .withColumn("inside_here", F.sum(inside).over(so_far))
        .withColumn("previous_here", F.last(row, True).over(earlier))
        .filter(is_row)
    )
    placed = null_safe_join(summed, carried, ["account_id", CHUNK], "inner").withColumn(
        "previous", F.coalesce("previous_here", "tail_before")
    )
    here = F.struct("__at", "idempotency_key")
    return join_short(placed, first_use, ["account_id", "merchant_category"]).select(
        *df.columns,
        (F.col("entered_before") + F.col("entered_here")).alias("position"),
        (F.col("inside_before") + F.col("inside_here")).alias("in_window"),
        here.eqNullSafe(F.col("first")).alias("first_use"),
        F.col("previous.city").alias("prev_city"),
        F.col("previous.__at").alias("prev_us"),
    )
