"""Failed deliveries wait in the state of a stream until their time, then come again.

Ingest writes its failures to a table; this stream keeps each until a processing-time timer
at its due time fires, and writes it to the table of due messages, which ingest reads beside
its other source. While the stream runs, timers fire without new messages. Waiting rows and
timers are in the state store, so they survive a restart; Spark then starts no empty batch
of its own, so they fire from the next failure on.

Messages are dealt over ``GROUPS`` state keys by a hash. What a micro-batch brings to one of
them for one time is an entry, or several of about ``ENTRY_BYTES``, with one timer; so calls
of the state store follow the number of groups and times, not of messages. Entries are
independent, so nothing that waits is read or written again before it is due.

Timers of processing time always ask for another batch: an ``availableNow`` run does not end.
Needs the RocksDB state store provider.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

import riskweave
from riskweave.schemas import ENVELOPE
from riskweave.session import scratch_scope
from riskweave.sources.tables import _exists, write_batch
from riskweave.streaming.store import RETRY, Store, require_own_batches

cloudpickle.register_pickle_by_value(riskweave)

COLUMNS = ENVELOPE.fieldNames()
#: State keys; a state partition holds several, so there should be many times as many.
GROUPS = 1024
ENTRY_BYTES = 1 << 20
WAITING = pa.schema([("body", pa.string()), ("retry_count", pa.int32()), ("message_id", pa.string())])


def packed(rows: pd.DataFrame) -> bytes:
    """Messages as one Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, WAITING) as out:
        out.write_table(pa.Table.from_pandas(rows[WAITING.names], WAITING, preserve_index=False))
    return sink.getvalue().to_pybytes()


def unpacked(entry: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(entry).read_all().to_pandas()[COLUMNS]


class RetryTimers(StatefulProcessor):
    """Holds the failed deliveries of a group of messages and hands each out when it is due."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "due bigint, entry string", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            part = pdf["body"].str.len().fillna(0).cumsum() // ENTRY_BYTES
            for (due, _), own in pdf.groupby([pdf["due"], part]):
                self.waiting.updateValue((int(due), uuid.uuid4().hex), (packed(own),))
                self.handle.registerTimer(int(due))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        # Another timer of the group may have handed out what this one was for.
        for entry in sorted(e for e in self.waiting.keys() if e[0] <= now):
            (found,) = self.waiting.getValue(entry)
            self.waiting.removeKey(entry)
            yield unpacked(found)
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def due_messages(failures: DataFrame) -> DataFrame:
    """The messages of a stream of failures, each when its ``available_at`` has come."""
    group = F.pmod(F.xxhash64("message_id", "body"), F.lit(GROUPS)).cast("int")
    waiting = failures.select(*COLUMNS, F.unix_millis("available_at").alias("due"), group.alias("key"))
    return waiting.groupBy("key").transformWithStateInPandas(
        statefulProcessor=RetryTimers(),
        outputStructType=ENVELOPE,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def read_failures(spark: SparkSession, store: Store) -> DataFrame:
    """The failures that ingest has written, as a stream."""
    _made(spark, store.failures, RETRY)
    return spark.readStream.schema(RETRY).option("ignoreMissingFiles", "true").parquet(store.failures)


def read_due(spark: SparkSession, store: Store) -> DataFrame:
    """The messages whose time has come, as a stream for ingest."""
    _made(spark, store.due, ENVELOPE)
    reader = spark.readStream.schema(ENVELOPE).option("ignoreMissingFiles", "true")
    return reader.parquet(store.due).select(*COLUMNS)


def _made(spark: SparkSession, path: str, schema) -> None:
    """A stream can only start on a folder that is there."""
    if not _exists(spark, path):
        spark.createDataFrame([], schema).write.mode("append").parquet(path)


def retry_stream(failures: DataFrame, store: Store) -> DataStreamWriter:
    """Writes failures to the table of due messages when their time has come."""
    require_own_batches(failures.sparkSession, store.due, store.progress("retry"))

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            write_batch(batch.select(*COLUMNS), store.due, batch_id, once=True)

    return due_messages(failures).writeStream.foreachBatch(run).option(
        "checkpointLocation", store.progress("retry")
    )
