"""Connected components of an undirected edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import apart, stored


def _settled(edges: DataFrame) -> bool:
    """Is every edge (a, b) one from a leaf to the root of its star?"""
    ends = (edges.select(F.col("a").alias("x"), F.lit(1).alias("up"))
            .unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("up"))))
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return seen.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node reachable.

    ``edges`` has columns a, b (long). Alternates large-star and small-star
    rounds until the edges are a star forest. Every step is an aggregate with
    map-side combine or an equi-join that the runtime can split on skew, and each
    round is written to the shared folder, so a lost executor costs one round.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                            F.least("a", "b").alias("b")).distinct(), "cc")
    for _ in range(max_rounds):
        if _settled(e):
            break
        # large star: larger neighbours of a node move to its smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(apart(low, "a"), "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        # small star: smaller neighbours of a node move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(apart(low, "a"), "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                         .alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        e = stored(small, "cc")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node")).distinct()
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(roots.select("node", F.col("node").alias("root"))))
