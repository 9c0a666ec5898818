"""Day histograms kept beside the transactions, so that a new batch moves the split boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from riskweave.constants import TRAIN_FRACTION
from riskweave.operators.features import with_label
from riskweave.operators.split import day_histogram, stored_split_boundaries, summed_days
from riskweave.session import scratch_scope
from riskweave.sources.tables import read_transactions
from riskweave.streaming.store import Store, require_own_batches
from riskweave.streaming.sums import add_sums, next_batch, read_sums

DAYS = T.StructType(
    [
        T.StructField("label", T.DoubleType()),
        T.StructField("day", T.TimestampType()),
        T.StructField("n", T.LongType()),
    ]
)


def add_days(txns: DataFrame, batch_id: int, store: Store) -> None:
    """Count the stored transactions of a micro-batch; a replay changes nothing."""
    add_sums(day_histogram(with_label(txns)), batch_id, store.days, summed_days)


def day_stream(txns: DataFrame, store: Store) -> DataStreamWriter:
    """Counts the transactions of the stored table as they come in."""
    require_own_batches(txns.sparkSession, store.days, store.progress("days"))

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            add_days(batch, batch_id, store)

    return txns.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("days"))


def read_days(spark: SparkSession, store: Store) -> DataFrame:
    """The histogram of everything counted so far."""
    return summed_days(read_sums(spark, store.days, DAYS, next_batch(spark, store.days)))


def current_boundaries(spark: SparkSession, store: Store, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """The split boundaries of the stored table; reads the boundary days only."""
    columns = ["idempotency_key", "bank", "occurred_at"]
    txns = with_label(read_transactions(spark, store.transactions, columns))
    return stored_split_boundaries(txns, read_days(spark, store), fraction)
