"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one edge only, to a ``v`` that is no ``u`` itself."""
    up = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"))
    ends = up.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    counted = ends.groupBy("x").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not counted.where("up > 1 or (up = 1 and n > 1)").limit(1).count()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an edge; root is the smallest node that can be reached.

    Alternates two steps until all is stars: each node sends its larger neighbours to
    its smallest neighbour, then its smaller neighbours and itself. A node with very many
    neighbours costs one minimum, made map-side, and a join that adaptive execution can
    split. Each round is written to the shared folder, so lost executors cost one round.
    """
    now = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
