"""Message stream to the transaction table, with retries and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from riskweave.constants import UNMARSHAL_PREFIX
from riskweave.operators.dedupe import dedupe_first
from riskweave.operators.validate import (
    accepted,
    dead_letters,
    rejected,
    retries,
    route_failures,
    validate,
)
from riskweave.schemas import ENVELOPE, TXN
from riskweave.sources.envelopes import parse_envelope, unparseable
from riskweave.session import delete_folder, scratch_scope
from riskweave.sources.tables import (
    read_batches,
    write_batch,
    write_observed,
)
from riskweave.streaming.keys import remember, store_new
from riskweave.streaming.retry import read_due
from riskweave.streaming.store import RETRY, TALLY, Store, require_own_batches

Clock = Callable[[int], datetime]
Handler = Callable[[], Column]
MESSAGE_COLUMNS = tuple(ENVELOPE.fieldNames())


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Envelopes as a stream of newline-delimited JSON files."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def topic_messages(records: DataFrame) -> DataFrame:
    """Envelopes from the columns of a Kafka source."""
    return records.select(
        F.col("value").cast("string").alias("body"),
        F.lit(0).alias("retry_count"),
        F.col("key").cast("string").alias("message_id"),
    )


def drop_recent_duplicates(
    messages: DataFrame, event_time: str, delay: str, key: str = "idempotency_key"
) -> DataFrame:
    """Bounded-memory duplicate filter ahead of the exact check at the sink."""
    return messages.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def dedupe_stream(rows: DataFrame, store: Store) -> DataStreamWriter:
    """Store each key of a stream of transactions once, however late its copies come.

    Without state and without a watermark: no row is too late, and no key is forgotten. Where
    most copies come soon, ``drop_recent_duplicates`` ahead of it spares them the look-up.
    """
    require_own_batches(rows.sparkSession, store.keys, store.progress("dedupe"))

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            first = dedupe_first(batch.select(*TXN.fieldNames()), "occurred_at")
            remember(store_new(first, batch_id, store), batch_id, store)

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("dedupe"))


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    store: Store,
    as_of: datetime,
    handler: Handler | None = None,
    *,
    timers: bool = False,
) -> None:
    """Store the new transactions of one micro-batch and route the rest.

    ``handler`` gives the error of a delivery that may succeed later, or NULL. Failures wait
    in a table for a batch after their due time, or, with ``timers``, go to the retry stream,
    whose due messages come in with ``batch``.
    Duplicates are looked for among the keys of all other batches, through filters first. Every table keeps the rows of a batch in a folder of its own, and the
    due retries and the outcome of each delivery are fixed by the first attempt, so a
    replay, from whatever point and with whatever clock, ends in the same tables.
    """
    spark = batch.sparkSession
    now = F.lit(as_of).cast("timestamp")
    # A replay may have a later clock or another outcome of its deliveries. What the first
    # attempt took and decided is therefore written down before anything is done with it.
    arrived = batch.select(*MESSAGE_COLUMNS)
    if not timers:
        waiting = read_batches(spark, store.retries, RETRY, batch_id - 1)
        marked = waiting.withColumn("due", F.col("available_at") <= now)
        write_batch(marked, store.waiting, batch_id, once=True)
        marked = read_batches(spark, store.waiting, marked.schema, batch_id)
        arrived = arrived.unionByName(marked.filter("due").select(*MESSAGE_COLUMNS))
    checked = validate(parse_envelope(arrived, now))
    failure = F.lit(None).cast("string") if handler is None else handler()
    checked = checked.withColumn("failure", F.when(F.col("error").isNull(), failure))
    broken = F.coalesce(F.col("error").startswith(UNMARSHAL_PREFIX), F.lit(False))
    counted = write_observed(checked, store.staged, batch_id, outcome_metrics(broken))
    checked = read_batches(spark, store.staged, checked.schema, batch_id)

    failed = checked.filter(F.col("failure").isNotNull()).select(
        *MESSAGE_COLUMNS, F.col("failure").alias("error"), "ingested_at"
    )
    # The delay runs from the first attempt, whose clock the staged rows carry.
    routed = route_failures(failed, as_of=F.col("ingested_at"))
    quarantined = (
        unparseable(checked)
        .unionByName(rejected(checked.filter(~broken), F.col("body")))
        .unionByName(dead_letters(routed))
    )
    write_batch(quarantined, store.quarantine, batch_id)
    again = retries(routed).select(*RETRY.fieldNames())
    if timers:
        write_batch(again, store.failures, batch_id, once=True)
    else:
        still_waiting = marked.filter("not due").drop("due")
        write_batch(again.unionByName(still_waiting), store.retries, batch_id)
    good = dedupe_first(
        accepted(checked.filter(F.col("failure").isNull())), "occurred_at", "body"
    ).select(*TXN.fieldNames())
    new = store_new(good, batch_id, store)
    tally = outcome_counts(spark, counted, new.count()).unionByName(
        routed.groupBy(F.col("route").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    )
    write_batch(tally.select(*TALLY.fieldNames()), store.tally, batch_id)
    remember(new, batch_id, store)
    # The batch before is committed, so it cannot come again.
    for path in (store.staged, store.waiting):
        delete_folder(spark, f"{path}/batch_id={batch_id - 1}")


def outcome_metrics(broken: Column) -> dict[str, Column]:
    """What is counted of a checked batch while it is staged."""
    valid = F.col("error").isNull() & F.col("failure").isNull()
    return {
        "valid": F.count_if(valid),
        "invalid": F.count_if(F.col("error").isNotNull() & ~broken),
        "unparseable": F.count_if(broken),
    }


def outcome_counts(spark: SparkSession, counted: dict[str, int], accepted_rows: int) -> DataFrame:
    """Rows per outcome of a staged batch of which ``accepted_rows`` are new."""
    rows = {
        "accepted": accepted_rows,
        "duplicate": counted["valid"] - accepted_rows,
        "invalid": counted["invalid"],
        "unparseable": counted["unparseable"],
    }
    return spark.createDataFrame(list(rows.items()), TALLY)


def ingest_stream(
    messages: DataFrame,
    store: Store,
    clock: Clock,
    handler: Handler | None = None,
    *,
    timers: bool = False,
) -> DataStreamWriter:
    """The stream, not yet started; the caller sets the trigger.

    With ``timers`` failures are left to ``retry_stream``, and its due messages are read
    beside ``messages``.
    """
    if timers:
        due = read_due(messages.sparkSession, store)
        messages = messages.select(*MESSAGE_COLUMNS).unionByName(due)
    require_own_batches(messages.sparkSession, store.keys, store.progress("ingest"))

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            ingest_batch(batch, batch_id, store, clock(batch_id), handler, timers=timers)

    return messages.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("ingest"))
