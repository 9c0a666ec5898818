"""Native bank feeds: schemas as data, JSON files, landed API pages.

Text fields are read as VARIANT so that a JSON number in a text field can be told
from a JSON string; numbers of the wrong JSON type come out NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.constants import UNMARSHAL_PREFIX
from riskweave.functions import parsed_once


@dataclass(frozen=True)
class Feed:
    """One bank's native shape: which native field fills which unified column."""

    bank: str
    native_id: str
    account_id: str
    merchant_name: str
    merchant_category: str
    city: str
    occurred_at: str
    amount: str
    amount_in_dollars: bool = False
    extra: Mapping[str, T.DataType] = field(default_factory=dict)

    @property
    def text_fields(self) -> tuple[str, ...]:
        return (
            self.native_id,
            self.account_id,
            self.merchant_name,
            self.merchant_category,
            self.city,
            self.occurred_at,
        )

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(name, T.VariantType()) for name in self.text_fields]
        fields.append(T.StructField(self.amount, T.DoubleType()))
        fields += [T.StructField(name, dtype) for name, dtype in self.extra.items()]
        return T.StructType(fields)


# Fixed field names of the three native formats.
FEEDS: dict[str, Feed] = {
    "bank-a": Feed(
        bank="bank-a",
        native_id="tx_id",
        account_id="acct",
        amount="amount",
        amount_in_dollars=True,
        merchant_name="merchant",
        merchant_category="mcc",
        city="city",
        occurred_at="ts",
    ),
    "bank-b": Feed(
        bank="bank-b",
        native_id="id",
        account_id="account_number",
        amount="amount_cents",
        merchant_name="desc",
        merchant_category="category_code",
        city="city_name",
        occurred_at="posted_at",
    ),
    "bank-c": Feed(
        bank="bank-c",
        native_id="uuid",
        account_id="account",
        amount="cents",
        merchant_name="payee",
        merchant_category="category",
        city="loc",
        occurred_at="when",
    ),
}


# Holds the original text of a record that does not fit the schema.
MISFIT = "__misfit"
_KEEP_MISFIT = {"columnNameOfCorruptRecord": MISFIT}


def _line_schema(feed: Feed) -> T.StructType:
    return T.StructType([*feed.schema.fields, T.StructField(MISFIT, T.StringType())])


def read_feed(spark: SparkSession, path: str, feed: Feed, *, array_file: bool = False) -> DataFrame:
    """Native rows of one feed.

    Newline-delimited JSON is splittable and the default; ``array_file`` reads one
    JSON array per file, which Spark can only read with one task per file.
    """
    reader = spark.read.schema(_line_schema(feed)).options(**_KEEP_MISFIT)
    return reader.json(path, multiLine=array_file)


def parse_records(df: DataFrame, feed: Feed, body: str = "body") -> DataFrame:
    """Native rows from a column of JSON record texts, other columns kept."""
    kept = [c for c in df.columns if c != body]
    parsed = F.from_json(F.col(body), _line_schema(feed), _KEEP_MISFIT)
    return df.select(*kept, parsed_once(parsed).alias("__record")).select(*kept, "__record.*")


def _page_schema(feed: Feed) -> T.StructType:
    return T.StructType(
        [
            T.StructField("transactions", T.ArrayType(feed.schema)),
            T.StructField("next_cursor", T.StringType()),
            T.StructField(MISFIT, T.StringType()),
        ]
    )


def unreadable_pages(pages: DataFrame, feed: Feed) -> DataFrame:
    """Pages without a readable list of records, as quarantine rows.

    Such a page gives no record, so a delivery is complete only if there are none.
    """
    page = parsed_once(F.from_json("body", _page_schema(feed), _KEEP_MISFIT)).alias("page")
    return (
        pages.select("page_no", "body", page)
        .filter(F.col("page.transactions").isNull())
        .select(
            "body",
            F.concat(F.lit(f"{feed.bank}:page-"), F.col("page_no")).alias("message_id"),
            F.lit(0).alias("retry_count"),
            F.lit(UNMARSHAL_PREFIX + "malformed page").alias("reason"),
        )
    )


def delivery_gaps(pages: DataFrame, feed: Feed) -> DataFrame:
    """``(page_no, problem)`` of a delivery that is not complete; no rows if it is.

    Pages count from 0, and every page but the last names the next one in ``next_cursor``.
    A delivery may only be used if each page is readable and the chain has no hole.
    """
    parsed = parsed_once(F.from_json("body", _page_schema(feed), _KEEP_MISFIT)).alias("page")
    read = pages.select("page_no", parsed).select(
        "page_no",
        F.col("page.transactions").isNotNull().alias("readable"),
        (F.coalesce(F.col("page.next_cursor"), F.lit("")) != "").alias("goes_on"),
    )
    after = read.select((F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("followed")).distinct()
    followed = F.coalesce("followed", F.lit(False))
    problem = (
        F.when(~F.col("readable"), F.lit("unreadable page"))
        .when(F.col("goes_on") & ~followed, F.lit("next page missing"))
        .when(~F.col("goes_on") & followed, F.lit("page after the last"))
    )
    found = read.join(after, "page_no", "left").select("page_no", problem.alias("problem"))
    first = pages.agg(F.min("page_no").alias("least")).select(
        F.lit(0).cast(pages.schema["page_no"].dataType).alias("page_no"),
        F.when(F.coalesce("least", F.lit(1)) > 0, F.lit("first page missing")).alias("problem"),
    )
    return found.unionByName(first).filter(F.col("problem").isNotNull())


def explode_pages(pages: DataFrame, feed: Feed) -> DataFrame:
    """Landed API pages ``(page_no, body)`` to one native row per record.

    ``body`` is ``{"transactions": [...], "next_cursor": ...}``. ``page_no`` and
    ``pos`` keep the order in which the records were served, which the feed
    deduplication needs. An empty page gives no row.
    """
    records = pages.select("page_no", F.from_json("body", _page_schema(feed)).alias("page")).select(
        "page_no", F.posexplode("page.transactions").alias("pos", "record")
    )
    return records.select("page_no", "pos", "record.*")
