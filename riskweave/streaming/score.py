"""Incremental rule scoring and classifier scoring over the stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from riskweave.constants import RuleSettings
from riskweave.operators.evaluate import evaluate
from riskweave.operators.flags import (
    as_new_flags,
    review_queue,
    status_counts,
)
from riskweave.operators.model import score_pending
from riskweave.operators.rules import score
from riskweave.operators.skew import null_safe_join, semi_join
from riskweave.operators.summary import Summary, last_times
from riskweave.schemas import RULE_INPUT, TXN
from riskweave.session import checkpoint_dir, materialize, scratch_scope
from riskweave.sources.tables import (
    KEY_BUCKET,
    bucket_of,
    read_transactions,
    touched_buckets,
    write_batch,
)
from riskweave.streaming.accounts import add_summary, read_summary
from riskweave.streaming.ingest import Clock
from riskweave.streaming.store import FLAG_LOG, Store, require_own_batches, stored_flags


def read_transaction_files(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Transactions appended to the stored table, as a stream.

    A crashed and repeated ingest batch may replace files this stream has listed; their
    rows come again in the new files.
    """
    reader = spark.readStream.schema(TXN).option("ignoreMissingFiles", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def score_batch(
    batch: DataFrame,
    batch_id: int,
    store: Store,
    as_of: datetime,
    settings: RuleSettings | None = None,
) -> None:
    """Score the rows of a micro-batch and log what changed.

    An account whose new rows are all later than what was seen of it is judged from its
    summary: neither its history nor the flag log is read, for a row seen for the first time
    has no flag yet. The other accounts are judged again from their first new row on, from
    the stored table, up to the last row that was seen; of these, only rows that are new or
    whose reasons changed are written. Both give the answer of a full rescan and upsert. The
    flag log is read without the batch's own rows, so a replay finds the same changes.
    """
    spark, settings = batch.sparkSession, settings or RuleSettings()
    window = settings.window_seconds
    # The micro-batch is read once.
    rows = materialize(batch.select(*RULE_INPUT), "arrivals")
    us = F.unix_micros("occurred_at")
    since = materialize(
        rows.groupBy("account_id").agg(F.min(us).alias("since_us"), F.max(us).alias("until_us")),
        "accounts",
    )
    buckets = touched_buckets(since, "account_id", store.buckets)
    if buckets:
        past = read_summary(spark, store, window, batch_id, buckets)
        # The accounts of the batch only; computed once, used for times, counts and categories.
        past = past.map(lambda part: _of_accounts(part, since)) if batch_id else past
        last = last_times(past.recent)
        late = null_safe_join(since, last, "account_id", "inner")
        late = materialize(late.filter(F.col("since_us") <= F.col("last_us")), "late-accounts")
        if late.isEmpty():
            found = _in_order(rows, past, settings)
        else:
            keys = late.select("account_id")
            others = lambda part: null_safe_join(part, keys, "account_id", "left_anti")
            found = _in_order(others(rows), past.map(others), settings)
            found = found.unionByName(_again(late, store, batch_id, settings))
        _log(found, batch_id, store, as_of)
    add_summary(rows, batch_id, store, window)


def _of_accounts(part: DataFrame, since: DataFrame) -> DataFrame:
    kept = null_safe_join(part, since.select("account_id"), "account_id", "left_semi")
    return materialize(kept, "summary")


def _in_order(rows: DataFrame, past: Summary, settings: RuleSettings) -> DataFrame:
    """Flagged rows of accounts that are not late; none has been judged before."""
    return score(rows, settings, past=past).withColumns(
        {"known_reasons": F.lit(None).cast("string"), "known_since": F.lit(None).cast("timestamp")}
    )


def _again(late: DataFrame, store: Store, batch_id: int, settings: RuleSettings) -> DataFrame:
    """Flagged rows of late accounts from their first new row on, and what was known of them."""
    spark = late.sparkSession
    buckets = touched_buckets(late, "account_id", store.buckets)
    history = read_transactions(spark, store.transactions, RULE_INPUT, buckets)
    # Stored rows that the stream has not seen yet are judged when they come.
    seen = F.greatest("until_us", "last_us").alias("seen_us")
    bounded = null_safe_join(history, late.select("account_id", seen), "account_id", "inner")
    bounded = bounded.filter(F.unix_micros("occurred_at") <= F.col("seen_us")).drop("seen_us")
    since = late.select("account_id", "since_us")
    scored = materialize(score(bounded, settings, since=since), "scored-again")
    buckets = touched_buckets(scored, "idempotency_key", store.buckets)
    known = stored_flags(spark, store, buckets, batch_id).select(
        "idempotency_key",
        F.col("reasons").alias("known_reasons"),
        F.col("created_at").alias("known_since"),
    )
    return scored.join(known, "idempotency_key", "left")


def _log(found: DataFrame, batch_id: int, store: Store, as_of: datetime) -> None:
    """Append flagged rows that are new or have other reasons than before."""
    changed = found.filter(~F.col("known_reasons").eqNullSafe(F.col("reasons")))
    now = F.lit(as_of).cast("timestamp")
    rows = (
        as_new_flags(changed, now, "known_since")
        .withColumn("created_at", F.coalesce("known_since", "created_at"))
        .withColumn("is_new", F.col("known_since").isNull())
        .withColumn(KEY_BUCKET, bucket_of(F.col("idempotency_key"), store.buckets))
        .drop("known_since")
    )
    write_batch(rows, store.flags, batch_id, once=True, partition=KEY_BUCKET)


def score_stream(
    txns: DataFrame, store: Store, clock: Clock, settings: RuleSettings | None = None
) -> DataStreamWriter:
    require_own_batches(txns.sparkSession, store.flags, store.progress("score"))

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            score_batch(batch, batch_id, store, clock(batch_id), settings)

    return txns.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("score"))


def score_pending_batch(
    batch: DataFrame,
    batch_id: int,
    store: Store,
    model: PipelineModel,
    settings: RuleSettings | None = None,
) -> None:
    """Score the new flags of a micro-batch of the change feed.

    The feed names each flag once and a batch is written once, so each flag is scored
    once. Only the flags' own key buckets and their accounts' buckets are read.
    """
    checkpoint_dir(batch.sparkSession)
    named = batch.select("idempotency_key", "account_id").checkpoint()
    if named.isEmpty():
        return
    buckets = touched_buckets(named, "idempotency_key", store.buckets)
    flags = stored_flags(batch.sparkSession, store, buckets)
    mine = semi_join(flags, named.select("idempotency_key"), "idempotency_key")
    # Scoring reads them several times: whose history, since when, how many reasons.
    mine = materialize(mine, "named-flags")
    theirs = touched_buckets(named, "account_id", store.buckets)
    history = read_transactions(batch.sparkSession, store.transactions, RULE_INPUT, theirs)
    scored = score_pending(mine, history, model, settings=settings)
    found = scored.filter(F.col("ml_score").isNotNull()).select("idempotency_key", "ml_score")
    write_batch(found, store.scores, batch_id, once=True)


def read_flag_feed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The change feed as a stream: the new rows of the flag log."""
    reader = spark.readStream.schema(FLAG_LOG).option("ignoreMissingFiles", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).filter("is_new")


def score_pending_stream(
    feed: DataFrame, store: Store, model: PipelineModel, settings: RuleSettings | None = None
) -> DataStreamWriter:
    require_own_batches(feed.sparkSession, store.scores, store.progress("classify"))

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            score_pending_batch(batch, batch_id, store, model, settings)

    return feed.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("classify"))


def dashboard_snapshot(
    txns: DataFrame, flags: DataFrame, status: str | None = None
) -> dict[str, DataFrame]:
    """What the review page shows: the queue, the counts, and metrics once attacks exist."""
    return {
        "queue": review_queue(flags, status),
        "counts": status_counts(flags),
        "metrics": evaluate(txns, flags).filter(F.col("attack_transactions") > 0),
    }
