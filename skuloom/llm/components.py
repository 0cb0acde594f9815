"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import checkpointed


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, written: bool = False) -> DataFrame:
    """(node, root) of every node that has an edge in (a, b); the root is the component's smallest node.

    Alternating large and small stars: every node's larger neighbours, then every node itself and its smaller neighbours,
    are linked to the smallest of them, until nothing changes. Each round is written to the shared folder. Minima are
    combined before the shuffle.

    All nodes of a component come to hang on one, which is then the key of most rows in the joins. With `written`, the minima
    and the edges between the two stars are written as well: a join of written tables is one that adaptive execution can
    split by key, at the price of three small tables more a round.
    """
    held = checkpointed if written else lambda df: df
    now = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = checkpointed(now.distinct())
    told = _sum(now)
    while True:
        both = now.union(now.select("b", "a"))
        least = held(both.groupBy("a").agg(F.min("b").alias("m")))
        # (v, smallest of u and its neighbours) for every larger neighbour v of u
        large = held(
            both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        least = held(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(
            joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        now = checkpointed(small.distinct())
        before, told = told, _sum(now)
        if told == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
