"""Account summaries kept as tables beside the scoring stream, as sums of micro-batches.

A batch reads the files of one generation at most, and only the buckets of its own accounts:
their number depends on the accounts, not on how many rows or batches came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.summary import COUNTS, Summary, in_last_window, summarize, summed_counts
from riskweave.schemas import RULE_INPUT, TXN
from riskweave.sources.tables import ACCOUNT_BUCKET, bucket_of
from riskweave.streaming.store import Store
from riskweave.streaming.sums import add_sums, read_sums

_SCHEMAS = {"counts": COUNTS, "recent": T.StructType([TXN[c] for c in RULE_INPUT])}


def _path(store: Store, kind: str, window_seconds: int) -> str:
    return f"{store.accounts}/{kind}-{window_seconds}s"


def read_summary(
    spark: SparkSession,
    store: Store,
    window_seconds: int,
    before_batch: int,
    account_buckets: Sequence[int] | None = None,
) -> Summary:
    """What micro-batches before one have seen, of all accounts or of some buckets.

    It is stacked, not merged. A stream that kept no summaries, or for another window, is
    refused.
    """

    def part(kind: str) -> DataFrame:
        path = _path(store, kind, window_seconds)
        rows = read_sums(spark, path, _SCHEMAS[kind], before_batch, ACCOUNT_BUCKET)
        if account_buckets is not None:
            rows = rows.filter(F.col(ACCOUNT_BUCKET).isin(*account_buckets))
        return rows.select(*_SCHEMAS[kind].fieldNames())

    return Summary(part("counts"), part("recent"))


def add_summary(rows: DataFrame, batch_id: int, store: Store, window_seconds: int) -> None:
    """Add the rows of a micro-batch; a replay changes nothing."""
    own = summarize(rows, window_seconds)

    def placed(part: DataFrame) -> DataFrame:
        return part.withColumn(ACCOUNT_BUCKET, bucket_of(F.col("account_id"), store.buckets))

    parts = {
        "counts": (own.counts, summed_counts),
        "recent": (own.recent, lambda stacked: in_last_window(stacked, window_seconds)),
    }
    for kind, (part, shortest) in parts.items():
        path = _path(store, kind, window_seconds)
        add_sums(placed(part), batch_id, path, lambda s, f=shortest: placed(f(s)), ACCOUNT_BUCKET)
