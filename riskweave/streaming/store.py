"""Where the streams keep their tables. Every table has exactly one writer.

The scoring stream owns the flags, the classifier stream the scores, and reviewers
append decisions; ``current_flags`` merges the three when they are read. So no two
writers ever touch the same files.

Flags are kept as a log: a micro-batch adds the rows that are new or have new reasons,
and the last row of a key is its flag. Nothing is rewritten, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.dedupe import dedupe_first
from riskweave.operators.flags import FLAG_COLUMNS, review
from riskweave.schemas import DECISION, FLAG
from riskweave.sources.tables import (
    DEFAULT_BUCKETS,
    KEY_BUCKET,
    _exists,
    batch_ids,
    read_batches,
    read_table,
)

RETRY = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("available_at", T.TimestampType()),
    ]
)
TALLY = T.StructType(
    [T.StructField("outcome", T.StringType()), T.StructField("n", T.LongType())]
)
# A flag as of one micro-batch, and whether its key appeared for the first time.
FLAG_LOG = T.StructType(
    [
        *FLAG.fields,
        T.StructField("is_new", T.BooleanType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField(KEY_BUCKET, T.IntegerType()),
    ]
)
SCORE = T.StructType(
    [T.StructField("idempotency_key", T.StringType()), T.StructField("ml_score", T.DoubleType())]
)

# Streams number their micro-batches from 0; loads of history take -1, -2 and so on.
HISTORY_BATCH = -1


@dataclass(frozen=True)
class Store:
    base: str
    buckets: int = DEFAULT_BUCKETS

    def _at(self, name: str) -> str:
        return f"{self.base}/{name}"

    @property
    def transactions(self) -> str:
        return self._at("transactions")

    @property
    def keys(self) -> str:
        return self._at("keys")

    @property
    def key_filters(self) -> str:
        return self._at("key_filters")

    @property
    def quarantine(self) -> str:
        return self._at("quarantine")

    @property
    def retries(self) -> str:
        return self._at("retries")

    @property
    def failures(self) -> str:
        """Failed deliveries for the retry stream, which hands them out through ``due``."""
        return self._at("failures")

    @property
    def due(self) -> str:
        return self._at("due")

    @property
    def tally(self) -> str:
        return self._at("tally")

    @property
    def flags(self) -> str:
        return self._at("flags")

    @property
    def scores(self) -> str:
        return self._at("scores")

    @property
    def decisions(self) -> str:
        return self._at("decisions")

    @property
    def staged(self) -> str:
        """What a micro-batch of messages was decided to be, for its replays."""
        return self._at("staged")

    @property
    def waiting(self) -> str:
        """The retries a micro-batch found, and which of them it took."""
        return self._at("waiting")

    @property
    def accounts(self) -> str:
        """Summaries of the accounts whose rows the scoring stream has seen."""
        return self._at("accounts")

    @property
    def days(self) -> str:
        """Rows per label and day of what was stored."""
        return self._at("days")

    @property
    def changes(self) -> str:
        """Signed changes of the numbers on the review page."""
        return self._at("changes")

    def progress(self, name: str) -> str:
        return self._at(f"progress/{name}")


def require_own_batches(spark: SparkSession, path: str, progress: str) -> None:
    """Fail if a table holds micro-batches of a stream whose progress is not there.

    A stream that starts anew numbers its batches from 0 again, and would take those of
    the stream before for its own and skip them.
    """
    if not _exists(spark, f"{progress}/metadata") and any(b >= 0 for b in batch_ids(spark, path)):
        raise RuntimeError(f"{path} holds micro-batches of another stream; use a new store")


def read_scores(spark: SparkSession, store: Store) -> DataFrame:
    return read_batches(spark, store.scores, SCORE)


def stored_flags(
    spark: SparkSession,
    store: Store,
    key_buckets: Sequence[int] | None = None,
    except_batch: int | None = None,
) -> DataFrame:
    """The last logged row of every key, without scores and decisions."""
    log = read_table(spark, store.flags, FLAG_LOG)
    if key_buckets is not None:
        log = log.filter(F.col(KEY_BUCKET).isin(*key_buckets))
    if except_batch is not None:
        log = log.filter(F.col("batch_id") != except_batch)
    return dedupe_first(log, F.desc("batch_id")).select(*FLAG_COLUMNS)


def read_new_flags(spark: SparkSession, store: Store) -> DataFrame:
    """The change feed: every flag as it was when its key first appeared."""
    return read_table(spark, store.flags, FLAG_LOG).filter("is_new").select(*FLAG_COLUMNS)


def record_decisions(decisions: DataFrame, store: Store) -> None:
    """Append reviewers' decisions."""
    decisions.select(*DECISION.fieldNames()).write.mode("append").parquet(store.decisions)


def _decisions(spark: SparkSession, store: Store) -> DataFrame:
    return read_table(spark, store.decisions, DECISION)


def with_scores(flags: DataFrame, scores: DataFrame) -> DataFrame:
    found = scores.select("idempotency_key", F.col("ml_score").alias("found"))
    return flags.join(found, "idempotency_key", "left").select(
        *[
            F.coalesce("found", "ml_score").alias(c) if c == "ml_score" else F.col(c)
            for c in FLAG_COLUMNS
        ]
    )


def current_flags(spark: SparkSession, store: Store) -> DataFrame:
    """The flag table as reviewers see it: flags, their scores, their latest decisions."""
    scored = with_scores(stored_flags(spark, store), read_scores(spark, store))
    return review(scored, _decisions(spark, store))
