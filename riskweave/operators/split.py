"""Chronological train/test split within each label."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.constants import CHUNK_ROWS, HEAVY_ACCOUNT_ROWS, TRAIN_FRACTION
from riskweave.operators.skew import CHUNK, before_chunk, range_chunks
from riskweave.session import materialize


def _moment() -> Column:
    return F.struct(F.unix_micros("occurred_at").alias("us"), F.col("idempotency_key"))


def _day() -> Column:
    return F.date_trunc("DAY", F.col("occurred_at"))


def split_boundaries(
    txns: DataFrame,
    fraction: float = TRAIN_FRACTION,
    *,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The last training row of each label: ``(label, last_train)``, one row per label.

    A label is a half of the table or more, so ranking it in one window would put
    it into one task. Rows are counted per (label, day) first; only the day that
    holds the boundary is ranked, and by range-sorted chunks if it is heavy.
    """
    days = boundary_days(day_histogram(txns), fraction)
    return boundaries_in(txns, days, heavy_rows=heavy_rows, chunk_rows=chunk_rows)


def day_histogram(txns: DataFrame) -> DataFrame:
    """(label, day, n): rows per label and day. Histograms of parts add up."""
    return txns.groupBy("label", _day().alias("day")).agg(F.count(F.lit(1)).alias("n"))


def summed_days(histogram: DataFrame) -> DataFrame:
    return histogram.groupBy("label", "day").agg(F.sum("n").alias("n"))


def boundary_days(histogram: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """One row per label: the day that holds its boundary, its rows, and the rank in it.

    A histogram may be stacked from parts. It has a row per label and day, so it is the only
    thing that is ever put in order.
    """
    by_label = W.partitionBy("label")
    so_far = by_label.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.sum("n").over(by_label)
    wanted = F.when(total > 1, F.greatest(F.floor(total * F.lit(fraction)), F.lit(1))).otherwise(
        total
    )
    return (
        summed_days(histogram)
        .withColumn("wanted", wanted)
        .withColumn("up_to", F.sum("n").over(so_far))
        .filter((F.col("up_to") >= F.col("wanted")) & (F.col("up_to") - F.col("n") < F.col("wanted")))
        .select(
            "label",
            "day",
            F.col("n").alias("day_rows"),
            (F.col("wanted") - F.col("up_to") + F.col("n")).alias("rank_in_day"),
        )
    )


def boundaries_in(
    txns: DataFrame,
    days: DataFrame,
    *,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The boundary row of each label, from the rows of its boundary day."""
    rows = txns.select("label", "occurred_at", "idempotency_key", _day().alias("day"))
    heaviest = days.agg(F.max("day_rows").alias("m"), F.sum("day_rows").alias("s")).first()
    # One row per label: two by construction of the label.
    in_day = rows.join(F.broadcast(days), ["label", "day"]).select(
        "label", "rank_in_day", _moment().alias("moment")
    )
    if (heaviest["m"] or 0) <= heavy_rows:
        ranked = in_day.withColumn(
            "rank", F.row_number().over(W.partitionBy("label").orderBy("moment"))
        )
    else:
        ranked = _rank_by_range(in_day, int(heaviest["s"]), chunk_rows)
    return ranked.filter(F.col("rank") == F.col("rank_in_day")).select(
        "label", F.col("moment").alias("last_train")
    )


def stored_split_boundaries(
    txns: DataFrame,
    histogram: DataFrame,
    fraction: float = TRAIN_FRACTION,
    *,
    heavy_rows: int = HEAVY_ACCOUNT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``split_boundaries`` from a histogram that was kept while the rows came in.

    Of ``txns``, which carries ``label`` and is everything the histogram has counted, only
    the boundary days are read: their limits reach the scan as filters on the time, so files
    of other days are passed over.
    """
    days = materialize(boundary_days(histogram, fraction), "boundary-days")
    at, one_day = F.col("occurred_at"), F.expr("interval 1 day")
    # One day per label.
    found = [F.lit(r["day"]).cast("timestamp") for r in days.select("day").distinct().collect()]
    inside = reduce(or_, [(at >= d) & (at < d + one_day) for d in found], F.lit(False))
    return boundaries_in(txns.filter(inside), days, heavy_rows=heavy_rows, chunk_rows=chunk_rows)


def _rank_by_range(in_day: DataFrame, rows: int, chunk_rows: int) -> DataFrame:
    """Rank within label by sorted chunks; only the chunk with the boundary is sorted again."""
    chunks = range_chunks(in_day, ["label", "moment"], rows, chunk_rows)
    carried = (
        chunks.groupBy("label", CHUNK)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rows_before", F.coalesce(F.sum("n").over(before_chunk("label")), F.lit(0)))
    )
    return (
        chunks.join(carried, ["label", CHUNK])
        .filter(
            (F.col("rank_in_day") > F.col("rows_before"))
            & (F.col("rank_in_day") <= F.col("rows_before") + F.col("n"))
        )
        .withColumn(
            "rank",
            F.col("rows_before")
            + F.row_number().over(W.partitionBy("label", CHUNK).orderBy("moment")),
        )
    )


def apply_split(df: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Add ``split``: ``train`` up to the boundary of the row's label, else ``test``.

    The boundaries are one row per label, so the big side is not shuffled.
    """
    return (
        df.join(F.broadcast(boundaries), "label")
        .withColumn(
            "split",
            F.when(_moment() <= F.col("last_train"), F.lit("train")).otherwise(F.lit("test")),
        )
        .drop("last_train")
    )


def chronological_split(df: DataFrame, fraction: float = TRAIN_FRACTION, **limits: int) -> DataFrame:
    return apply_split(df, split_boundaries(df, fraction, **limits))
