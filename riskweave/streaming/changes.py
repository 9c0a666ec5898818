"""The review page's numbers, kept up by signed changes instead of recounts.

New flags and reviewers' decisions meet per key in a small state: whether the key is flagged,
and its latest decision. Whatever changes a flag's status gives one row with -1 and one with
+1; a new flag and a stored transaction count into the totals of the evaluation. A micro-batch
adds up its changes and appends a dozen numbers, whatever the size of the tables.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

import riskweave
from riskweave.constants import ATTACK_BANK, DEFAULT_STATUS, STATUSES
from riskweave.operators.evaluate import COUNTS, ratios
from riskweave.schemas import DECISION
from riskweave.session import scratch_scope
from riskweave.streaming.store import Store, require_own_batches
from riskweave.streaming.sums import add_sums, next_batch, read_sums

cloudpickle.register_pickle_by_value(riskweave)

CHANGES = T.StructType([T.StructField("measure", T.StringType()), T.StructField("n", T.LongType())])
MEASURES = (*STATUSES, *COUNTS)
#: Groups that the keys are dealt over by hash, whatever their number: a group's fixed cost in
#: Python is shared by its keys, and a micro-batch rewrites the state of the groups it has.
KEY_GROUPS = 1 << 14

_KNOWN = pa.schema(
    [("key", pa.string()), ("flagged", pa.bool_()), ("us", pa.int64()), ("decision", pa.string())]
)


class StatusChanges(StatefulProcessor):
    """Changes of the counts by flags and decisions, in any order of arrival.

    The group is a key, or a bucket of keys whose rows then name theirs. What is known of a
    group's keys is one packed table, so a group costs one read and one write of the state
    however many of its keys a micro-batch has.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "keys binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self._read()
        before: dict[str | None, tuple[bool, tuple | None]] = {}
        after: dict[str | None, tuple[bool, tuple | None]] = {}
        for pdf in rows:
            names = pdf["idempotency_key"] if "idempotency_key" in pdf else pd.Series([key[0]] * len(pdf))
            columns = (names, pdf["is_flag"], pdf["decided_us"], pdf["decision"])
            for name, is_flag, us, decision in zip(*(c.tolist() for c in columns), strict=True):
                name = None if pd.isna(name) else name
                if name not in after:
                    before[name] = after[name] = known.get(name, (False, None))
                flagged, latest = after[name]
                if is_flag:
                    flagged = True
                else:
                    latest = max(latest or (int(us), decision), (int(us), decision))
                after[name] = (flagged, latest)
        changed = {name: now for name, now in after.items() if now != before[name]}
        changes: Counter[str] = Counter()
        for name, now in changed.items():
            changes.subtract(self._counted(*before[name]))
            changes.update(self._counted(*now))
        if changed:
            self._write(known | changed)
        yield pd.DataFrame([c for c in changes.items() if c[1]], columns=["measure", "n"]).astype({"n": "int64"})

    def close(self) -> None:
        pass

    def _counted(self, flagged: bool, latest: tuple | None) -> list[str]:
        if not flagged:
            return []
        return [latest[1] if latest else DEFAULT_STATUS]

    def _read(self) -> dict[str | None, tuple[bool, tuple | None]]:
        if not self.known.exists():
            return {}
        table = pa.ipc.open_stream(self.known.get()[0]).read_all()
        return {
            name: (flagged, None if us is None else (us, decision))
            for name, flagged, us, decision in zip(*(c.to_pylist() for c in table.columns), strict=True)
        }

    def _write(self, known: dict[str | None, tuple[bool, tuple | None]]) -> None:
        rows = [(name, flagged, *(latest or (None, None))) for name, (flagged, latest) in known.items()]
        columns = zip(*rows, strict=True)
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, _KNOWN, strict=True)], _KNOWN)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _KNOWN) as writer:
            writer.write_table(table)
        self.known.update((out.getvalue().to_pybytes(),))


def status_changes(feed: DataFrame, decisions: DataFrame) -> DataFrame:
    """(measure, n): signed changes of the rows per status, from two streams.

    ``feed`` names every new flag, ``decisions`` are the reviewers'. The latest decision of a
    key counts, also if it comes before the flag; one on a key that is never flagged counts
    nothing, and one that is neither approved nor denied is an error.
    """
    allowed = F.col("decision").isin(*[s for s in STATUSES if s != DEFAULT_STATUS])
    checked = F.when(allowed, F.col("decision")).otherwise(
        F.raise_error(F.concat(F.lit("unknown decision: "), F.col("decision"))).cast("string")
    )
    flags = feed.select(
        "idempotency_key",
        F.lit(True).alias("is_flag"),
        F.lit(None).cast("string").alias("decision"),
        F.lit(None).cast("bigint").alias("decided_us"),
    )
    decided = decisions.select(
        "idempotency_key",
        F.lit(False).alias("is_flag"),
        checked.alias("decision"),
        F.unix_micros("decided_at").alias("decided_us"),
    )
    return (
        flags.unionByName(decided)
        .withColumn("key_group", F.pmod(F.xxhash64("idempotency_key"), F.lit(KEY_GROUPS)))
        .groupBy("key_group")
        .transformWithStateInPandas(
            statefulProcessor=StatusChanges(),
            outputStructType=CHANGES,
            outputMode="Append",
            timeMode="None",
        )
    )


def read_decisions(spark: SparkSession, store: Store, max_files: int | None = None) -> DataFrame:
    """Reviewers' decisions as a stream."""
    reader = spark.readStream.schema(DECISION)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(store.decisions)


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("measure").agg(F.sum("n").alias("n"))


def _one_each(rows: DataFrame, attack, kind: str) -> DataFrame:
    named = F.when(attack, F.lit(f"attack_{kind}")).otherwise(F.lit(f"legit_{kind}"))
    return rows.select(named.alias("measure"), F.lit(1).cast("bigint").alias("n"))


def change_stream(txns: DataFrame, feed: DataFrame, decisions: DataFrame, store: Store) -> DataStreamWriter:
    """Keeps the numbers up with the stored transactions, the new flags and the decisions.

    The feed names each key once. Needs the RocksDB state store provider.
    """
    require_own_batches(feed.sparkSession, store.changes, store.progress("changes"))
    of_attack = F.col("idempotency_key").startswith(f"{ATTACK_BANK}:")
    changes = (
        status_changes(feed, decisions)
        .unionByName(_one_each(feed, of_attack, "flagged"))
        .unionByName(_one_each(txns, F.col("bank") == ATTACK_BANK, "transactions"))
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            add_sums(_summed(batch), batch_id, store.changes, _summed)

    return changes.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("changes"))


def current_numbers(spark: SparkSession, store: Store) -> DataFrame:
    """(measure, n): rows per status and the counts of the evaluation, 0 included."""
    stacked = read_sums(spark, store.changes, CHANGES, next_batch(spark, store.changes))
    totals = stacked.agg(
        *[F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).alias(m) for m in MEASURES]
    )
    named = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("n")) for m in MEASURES]
    return totals.select(F.inline(F.array(*named)))


def current_metrics(spark: SparkSession, store: Store) -> DataFrame:
    """The evaluation from the kept numbers, one row."""
    numbers = current_numbers(spark, store)
    wide = numbers.agg(*[F.sum(F.when(F.col("measure") == c, F.col("n"))).alias(c) for c in COUNTS])
    return ratios(wide)
