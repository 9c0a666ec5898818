"""Stored tables: Parquet, laid out for the way they are read.

Transactions are read per account, so they are partitioned by a hash bucket of the
account; flags are read and replaced by key, so by a hash bucket of the key.
Rebalancing before a write splits the files of a bucket that a hot account fills.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.dedupe import dedupe_against_store
from riskweave.operators.flags import FLAG_COLUMNS
from riskweave.operators.validate import add_missing_columns, require_columns
from riskweave.schemas import FLAG, QUARANTINE, TXN
from riskweave.session import _file_system, checkpoint_dir, delete_folder, rename_folder

ACCOUNT_BUCKET = "account_bucket"
KEY_BUCKET = "key_bucket"
EVENT_DATE = "event_date"
DEFAULT_BUCKETS = 64


def bucket_of(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _file_system(spark, path)
    return bool(system.exists(hadoop))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    if not _exists(spark, path):
        return []
    system, hadoop = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(hadoop)]


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """The micro-batches that have a folder in a table."""
    names = [n.removeprefix("batch_id=") for n in _names(spark, path) if n.startswith("batch_id=")]
    return sorted(int(n) for n in names)


def _with_field(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.IntegerType())])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows while nothing has been written yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_transactions(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    account_buckets: Sequence[int] | None = None,
) -> DataFrame:
    """Stored transactions, pruned to ``columns`` and to the given account buckets.

    There is no global sort: order is restored inside the per-account windows. An
    empty table is returned for a path that does not exist yet.
    """
    df = read_table(spark, path, _with_field(TXN, ACCOUNT_BUCKET))
    if account_buckets is not None:
        df = df.filter(F.col(ACCOUNT_BUCKET).isin(*account_buckets))
    return df.select(*(TXN.fieldNames() if columns is None else columns))


def write_transactions(txns: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Append rows; the caller has dropped keys that are already stored."""
    rows = add_missing_columns(txns, {"city": "string", "raw": "string"}).select(
        *TXN.fieldNames(), bucket_of(F.col("account_id"), buckets).alias(ACCOUNT_BUCKET)
    )
    (
        rows.hint("rebalance", ACCOUNT_BUCKET)
        .write.mode("append")
        .partitionBy(ACCOUNT_BUCKET)
        .parquet(path)
    )


def insert_transactions(
    batch: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS, order: Sequence[str] = ("occurred_at",)
) -> None:
    """Append the rows whose key is not stored yet, the first in ``order`` per key."""
    stored = read_transactions(batch.sparkSession, path, ["idempotency_key"])
    write_transactions(dedupe_against_store(batch, stored, *order), path, buckets)


def compact_transactions(
    spark: SparkSession, path: str, target: str, buckets: int = DEFAULT_BUCKETS
) -> None:
    """The table of ``path`` written anew under ``target``, with few files per bucket.

    Files are sorted by account and time, so their minima and maxima let a reader of one
    account or of recent times skip most of them. ``path`` is only read; whoever switches
    to ``target`` may delete it afterwards.
    """
    rows = read_transactions(spark, path).withColumn(
        ACCOUNT_BUCKET, bucket_of(F.col("account_id"), buckets)
    )
    (
        rows.hint("rebalance", ACCOUNT_BUCKET)
        .sortWithinPartitions(ACCOUNT_BUCKET, "account_id", "occurred_at", "idempotency_key")
        .write.partitionBy(ACCOUNT_BUCKET)
        .parquet(target)
    )


def write_dated_transactions(txns: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Append rows by date and account bucket, sorted by account and time inside a file.

    A look-back of minutes then lists the folders of one or two days and of the accounts'
    buckets, and within a file the minima and maxima of its row groups pass over other
    accounts. A day that one account fills is split into several files.
    """
    rows = add_missing_columns(txns, {"city": "string", "raw": "string"}).select(
        *TXN.fieldNames(),
        F.to_date("occurred_at").alias(EVENT_DATE),
        bucket_of(F.col("account_id"), buckets).alias(ACCOUNT_BUCKET),
    )
    (
        rows.hint("rebalance", EVENT_DATE, ACCOUNT_BUCKET)
        .sortWithinPartitions(EVENT_DATE, ACCOUNT_BUCKET, "account_id", "occurred_at")
        .write.mode("append")
        .partitionBy(EVENT_DATE, ACCOUNT_BUCKET)
        .parquet(path)
    )


def read_dated_transactions(
    spark: SparkSession,
    path: str,
    first: datetime,
    last: datetime,
    look_back_seconds: int = 0,
    columns: Sequence[str] | None = None,
    account_buckets: Sequence[int] | None = None,
) -> DataFrame:
    """Rows from ``first`` less the look-back to ``last``, both included.

    The limits prune days by folder and row groups by their minima and maxima.
    """
    schema = T.StructType([*TXN.fields, T.StructField(EVENT_DATE, T.DateType())])
    start, end = (F.lit(t).cast("timestamp") for t in (first - timedelta(seconds=look_back_seconds), last))
    at, day = F.col("occurred_at"), F.col(EVENT_DATE)
    df = read_table(spark, path, _with_field(schema, ACCOUNT_BUCKET))
    df = df.filter((day >= F.to_date(start)) & (day <= F.to_date(end)) & (at >= start) & (at <= end))
    if account_buckets is not None:
        df = df.filter(F.col(ACCOUNT_BUCKET).isin(*account_buckets))
    return df.select(*(TXN.fieldNames() if columns is None else columns))


def save_account_table(txns: DataFrame, name: str, path: str, buckets: int) -> None:
    """Transactions as a catalog table bucketed and sorted by account.

    The account windows of rules and features read it without a shuffle, so it pays
    when the whole history is scored repeatedly.
    """
    (
        txns.write.mode("overwrite")
        .bucketBy(buckets, "account_id")
        .sortBy("account_id", "occurred_at", "idempotency_key")
        .option("path", path)
        .saveAsTable(name)
    )


def count_transactions(txns: DataFrame) -> DataFrame:
    return txns.agg(F.count(F.lit(1)).alias("n"))


def verify_transactions(df: DataFrame) -> DataFrame:
    """Fail unless every column of the transaction schema is there with its type."""
    return require_columns(df, {f.name: f.dataType.simpleString() for f in TXN.fields})


def read_flags(
    spark: SparkSession, path: str, key_buckets: Sequence[int] | None = None
) -> DataFrame:
    df = read_table(spark, path, _with_field(FLAG, KEY_BUCKET))
    if key_buckets is not None:
        df = df.filter(F.col(KEY_BUCKET).isin(*key_buckets))
    return df.select(*FLAG_COLUMNS)


def read_flag(
    spark: SparkSession, path: str, key: str, buckets: int = DEFAULT_BUCKETS
) -> DataFrame:
    """One flag by key; only the key's bucket is listed and read."""
    df = read_table(spark, path, _with_field(FLAG, KEY_BUCKET))
    return df.filter(
        (F.col(KEY_BUCKET) == bucket_of(F.lit(key), buckets)) & (F.col("idempotency_key") == key)
    ).select(*FLAG_COLUMNS)


def touched_buckets(df: DataFrame, column: str, buckets: int) -> list[int]:
    """Buckets that hold a value of ``column``; at most ``buckets`` integers reach the driver."""
    found = df.select(bucket_of(F.col(column), buckets).alias("b")).distinct()
    return sorted(row["b"] for row in found.collect())


def replace_flags(flags: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Write ``flags`` over the key buckets they fall into; other buckets stay.

    ``flags`` must hold every row of the touched buckets. It usually derives from
    the table itself, so it is first checkpointed: its files are about to go.
    """
    checkpoint_dir(flags.sparkSession)
    rows = flags.select(
        *FLAG_COLUMNS, bucket_of(F.col("idempotency_key"), buckets).alias(KEY_BUCKET)
    ).checkpoint()
    (
        rows.hint("rebalance", KEY_BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(KEY_BUCKET)
        .parquet(path)
    )


def write_batch(
    df: DataFrame, path: str, batch_id: int, once: bool = False, partition: str | None = None
) -> None:
    """Write the rows of one micro-batch to its own folder.

    A replay of the batch replaces them, or, with ``once``, keeps what a completed
    first attempt wrote: for rows that other streams may already be reading. Such a folder
    is written under a name that readers pass over and renamed when it is complete, so a
    reader never meets files of an attempt that broke off.
    """
    spark = df.sparkSession
    folder = f"{path}/batch_id={batch_id}"
    if once and _exists(spark, f"{folder}/_SUCCESS"):
        return
    target = f"{path}/_attempt-{batch_id}" if once else folder
    if partition is not None:
        df = df.hint("rebalance", partition)
    writer = df.write.mode("overwrite")
    (writer if partition is None else writer.partitionBy(partition)).parquet(target)
    if once:
        delete_folder(spark, folder)
        rename_folder(spark, target, folder)


def write_observed(
    df: DataFrame, path: str, batch_id: int, metrics: dict[str, Column]
) -> dict[str, int]:
    """``write_batch`` once, and aggregates of the rows that are taken while they are written.

    The write is the only scan. A replay that finds the rows written reads the same numbers
    from the written folder.
    """
    spark = df.sparkSession
    named = [m.alias(name) for name, m in metrics.items()]
    if _exists(spark, f"{path}/batch_id={batch_id}/_SUCCESS"):
        return read_batches(spark, path, df.schema, batch_id).agg(*named).first().asDict()
    seen = Observation()
    write_batch(df.observe(seen, *named), path, batch_id, once=True)
    return seen.get


def write_transaction_batch(
    txns: DataFrame, path: str, batch_id: int, buckets: int = DEFAULT_BUCKETS
) -> None:
    """The new rows of one micro-batch, by account bucket."""
    rows = txns.select(
        *TXN.fieldNames(), bucket_of(F.col("account_id"), buckets).alias(ACCOUNT_BUCKET)
    )
    write_batch(rows, path, batch_id, once=True, partition=ACCOUNT_BUCKET)


def write_key_batch(
    txns: DataFrame, path: str, batch_id: int, buckets: int = DEFAULT_BUCKETS
) -> None:
    """The keys of one micro-batch, by key bucket: the index for the duplicate check."""
    key = F.col("idempotency_key")
    rows = txns.select(key, bucket_of(key, buckets).alias(KEY_BUCKET))
    write_batch(rows, path, batch_id, once=True, partition=KEY_BUCKET)


def read_keys(
    spark: SparkSession, path: str, key_buckets: Sequence[int], except_batch: int
) -> DataFrame:
    """Keys of other micro-batches in the given buckets; partitions outside are not listed."""
    schema = T.StructType(
        [
            TXN["idempotency_key"],
            T.StructField("batch_id", T.LongType()),
            T.StructField(KEY_BUCKET, T.IntegerType()),
        ]
    )
    kept = F.col(KEY_BUCKET).isin(*key_buckets) & (F.col("batch_id") != except_batch)
    return read_table(spark, path, schema).filter(kept).select("idempotency_key")


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType = QUARANTINE, batch_id: int | None = None
) -> DataFrame:
    """All micro-batches of a table, or one; for one only its own folder is listed."""
    if batch_id is not None:
        return read_table(spark, f"{path}/batch_id={batch_id}", schema)
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return read_table(spark, path, full).select(*schema.fieldNames())
