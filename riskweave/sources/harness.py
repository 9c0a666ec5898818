"""The driver's test tables seen as transactions.

``events`` is a stream of user actions and ``orders`` a table with many rows at
the same instant (midnight dates); neither is a transaction table by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.constants import ATTACK_BANK, CITIES, CURRENCY
from riskweave.functions import dollars_to_cents, idempotency_key
from riskweave.session import use_utc

# Fixed values of the adapter.
EVENT_CATEGORIES = (
    ("click", "5814"),
    ("view", "4111"),
    ("purchase", "5411"),
    ("signup", "7372"),
    ("error", "7995"),
)
INGESTED_AT = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _nth_city(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c, _, _ in CITIES]), index.cast("int") + 1)


def event_category() -> Column:
    mapping = [F.lit(x) for pair in EVENT_CATEGORIES for x in pair]
    return F.element_at(F.create_map(*mapping), F.col("event_type"))


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def event_city() -> Column:
    """Users live in one city and are now and then seen in another."""
    k = event_k()
    return _nth_city(F.when(k < 5, k + 5).otherwise(F.col("user_id") % 10))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    bank = F.when(F.col("event_type") == "error", F.lit(ATTACK_BANK)).otherwise(F.lit("bank-a"))
    native_id = F.col("event_id").cast("string")
    return events.select(
        idempotency_key(bank, native_id).alias("idempotency_key"),
        bank.alias("bank"),
        native_id.alias("native_id"),
        F.col("user_id").cast("string").alias("account_id"),
        dollars_to_cents(F.col("value")).alias("amount_cents"),
        F.lit(CURRENCY).alias("currency"),
        F.col("event_type").alias("merchant_name"),
        event_category().alias("merchant_category"),
        event_city().alias("city"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
        instant(INGESTED_AT).alias("ingested_at"),
        F.col("props").alias("raw"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    native_id = F.col("o_orderkey").cast("string")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        idempotency_key(F.lit("bank-b"), native_id).alias("idempotency_key"),
        F.lit("bank-b").alias("bank"),
        native_id.alias("native_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        dollars_to_cents(F.col("o_totalprice")).alias("amount_cents"),
        F.lit(CURRENCY).alias("currency"),
        F.col("o_orderstatus").alias("merchant_name"),
        F.col("o_orderpriority").alias("merchant_category"),
        _nth_city(F.col("c_nationkey") % 10).alias("city"),
        F.col("o_orderdate").cast("timestamp").alias("occurred_at"),
        instant(INGESTED_AT).alias("ingested_at"),
        F.lit(None).cast("string").alias("raw"),
    )
