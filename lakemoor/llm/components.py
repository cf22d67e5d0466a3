"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemoor.llm.shared import discard, materialise


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """edges: (a, b) of any orderable type. Gives (node, root), root the least node of its component; nodes without edges are absent.

    Every step is a grouped minimum (combined before the shuffle) and an equi-join, whose hot keys
    adaptive execution splits; nothing about the graph comes to the driver but whether it is done.
    """
    now = materialise(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most):
        if _stars(now):
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b")
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x <> y")
        last, now = now, materialise(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        discard(last)
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node is a root or hangs on one root: then the components are done."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("v").agg(F.max("up").alias("up"), F.sum("down").alias("down")).filter("down > 1 or up = 1 and down > 0").isEmpty()
