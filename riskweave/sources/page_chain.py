"""The order of landed pages from their cursors alone.

A page is the answer to a request with a cursor and names the cursor of the next one; the
first request has none, and the last page names none. Pages may land in any order, more than
once, or not at all. The chain is followed by pointer jumping: after k rounds every page
knows the page 2^k further on, and the pages found so far are twice as many, so a delivery of
n pages takes some log2(n) joins, whatever the order they lie in.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import parsed_once
from riskweave.session import materialize
from riskweave.sources.feeds import _KEEP_MISFIT, Feed, _page_schema

#: The cursor of the first request, and what the last page names.
START = ""

FIRST_MISSING = "first page missing"
UNREADABLE = "unreadable page"
FORK = "two next pages"
HOLE = "next page missing"
LOOP = "loops back"
OFF = "not on the chain"


def page_links(pages: DataFrame, feed: Feed) -> DataFrame:
    """(delivery, cursor, next_cursor, readable, ways): one row for each cursor.

    A page that was served again counts once. If its servings name different pages, the
    least cursor is followed and ``ways`` tells their number; ``next_cursor`` is NULL where
    no serving is readable.
    """
    parsed = parsed_once(F.from_json("body", _page_schema(feed), _KEEP_MISFIT)).alias("page")
    served = pages.select("delivery", F.coalesce("cursor", F.lit(START)).alias("cursor"), parsed)
    goes_on = F.coalesce(F.col("page.next_cursor"), F.lit(START))
    named = F.when(F.col("page.transactions").isNotNull(), goes_on)
    return (
        served.select("delivery", "cursor", named.alias("named"))
        .groupBy("delivery", "cursor")
        .agg(F.min("named").alias("next_cursor"), F.count_distinct("named").cast("int").alias("ways"))
        .withColumn("readable", F.col("ways") > 0)
    )


def page_positions(links: DataFrame) -> DataFrame:
    """(delivery, cursor, position) of the pages that the first request leads to, from 0 on.

    A chain that comes back to a page ends there.
    """
    landed = links.select("delivery", "cursor")
    # One jump ahead: only to pages that have landed.
    jumps = (
        links.filter(F.col("next_cursor") != START)
        .select("delivery", F.col("next_cursor").alias("cursor"), F.col("cursor").alias("origin"))
        .join(landed, ["delivery", "cursor"])
        .select("delivery", F.col("origin").alias("cursor"), F.col("cursor").alias("ahead"))
    )
    jumps = materialize(jumps, "page-jumps")
    found = landed.filter(F.col("cursor") == START).withColumn("position", F.lit(0).cast("bigint"))
    found = materialize(found, "page-positions")
    longest = landed.groupBy("delivery").count().agg(F.max("count")).first()[0] or 0
    for k in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        step = found.join(jumps, ["delivery", "cursor"]).select(
            "delivery", F.col("ahead").alias("cursor"), (F.col("position") + 2**k).alias("position")
        )
        # A page that a loop meets again keeps its first place.
        reached = found.unionByName(step).groupBy("delivery", "cursor").agg(F.min("position").alias("position"))
        found = materialize(reached, "page-positions")
        further = jumps.select("delivery", F.col("cursor").alias("origin"), F.col("ahead").alias("cursor")).join(
            jumps, ["delivery", "cursor"]
        )
        jumps = materialize(
            further.select("delivery", F.col("origin").alias("cursor"), "ahead"), "page-jumps"
        )
    return found


def page_chain(pages: DataFrame, feed: Feed) -> DataFrame:
    """(delivery, cursor, position, problem) of every landed page, and what is missing.

    ``pages`` are ``(delivery, cursor, body)``; each delivery is a chain of its own. A delivery
    without problems is complete, and ``position`` is the order of its pages. Otherwise:

    * ``first page missing``: a row for the first request, which no page answers
    * ``unreadable page``: the page has no list of records, so nothing follows it
    * ``two next pages``: servings of the page name different pages; the least is followed
    * ``next page missing``: the page that it names has not landed
    * ``loops back``: the page that it names comes before it, or is the page itself
    * ``not on the chain``: nothing leads from the first request to the page
    """
    links = materialize(page_links(pages, feed), "page-links")
    placed = materialize(links.join(page_positions(links), ["delivery", "cursor"], "left"), "placed-pages")
    ahead = placed.select(
        "delivery",
        F.col("cursor").alias("next_cursor"),
        F.lit(True).alias("has_landed"),
        F.col("position").alias("next_position"),
    )
    hole = (F.col("next_cursor") != START) & F.col("has_landed").isNull()
    problem = (
        F.when(F.col("position").isNull(), F.lit(OFF))
        .when(~F.col("readable"), F.lit(UNREADABLE))
        .when(F.col("ways") > 1, F.lit(FORK))
        .when(hole, F.lit(HOLE))
        .when(F.col("next_position") <= F.col("position"), F.lit(LOOP))
    )
    # The first page comes after none: a page that names the start has ended the chain.
    found = placed.join(ahead.filter(F.col("next_cursor") != START), ["delivery", "next_cursor"], "left")
    found = found.select("delivery", "cursor", "position", problem.alias("problem"))
    headless = (
        links.groupBy("delivery")
        .agg(F.max(F.col("cursor") == START).alias("begins"))
        .filter(~F.col("begins"))
        .select(
            "delivery",
            F.lit(START).alias("cursor"),
            F.lit(None).cast("bigint").alias("position"),
            F.lit(FIRST_MISSING).alias("problem"),
        )
    )
    return found.unionByName(headless)


def numbered_pages(pages: DataFrame, feed: Feed) -> DataFrame:
    """``pages`` of complete chains as ``(delivery, page_no, body)``, and of others what leads on.

    The page number is the place in the chain, so records come in the order they were served,
    whatever the table's own numbers say. Pages that are not on the chain are left out; the
    caller decides with ``page_chain`` whether the delivery may be used.
    """
    chain = page_chain(pages, feed).filter(F.col("position").isNotNull())
    keyed = pages.withColumn("cursor", F.coalesce("cursor", F.lit(START)))
    return keyed.join(chain.select("delivery", "cursor", "position"), ["delivery", "cursor"]).select(
        "delivery", F.col("position").alias("page_no"), "body"
    )
