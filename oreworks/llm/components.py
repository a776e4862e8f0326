"""Connected components of a graph of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.lineage import cut


def _both(a: str, b: str, c: str, d: str) -> Column:
    """The links (a, b) and (c, d)."""
    ends = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ((a, b), (c, d))]
    return F.array(*ends)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Ties each node's neighbours to the smallest of them and itself: the larger ones, or
    the smaller ones and itself."""
    if large:
        near = edges.select(F.inline(_both("a", "b", "b", "a")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    tied = near.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.inline(_both("b", "m", "a", "m")))
    return out.where("a <> b")


def _settled(edges: DataFrame) -> bool:
    """Is every node tied to one root, and no root to another?"""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("ties"), F.lit(0).alias("root")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("ties"), F.lit(1).alias("root")),
    )
    n = (F.sum("ties") + F.max("root")).alias("n")
    return edges.select(F.inline(ends)).groupBy("node").agg(n).where("n > 1").isEmpty()


def ties(edges: DataFrame) -> DataFrame:
    """node, root for every node of the links (a, b) that reaches a smaller one.

    root is the smallest node that it reaches. Links of a node with itself and links with a
    null are left out. Every step reduces by key before it shuffles, and is cut off from the
    one before: it reads that twice, and with it all that it was made from. A step gives at
    most as many rows as it gets, so only the second of two looks for equal ones.
    """
    now = edges.select("a", "b").where("a <> b")
    settled = False
    while not settled:
        now = cut(_star(cut(_star(now, True), free=False), False).distinct())
        settled = _settled(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the links (a, b): root is the smallest node that it reaches.

    Nodes without links are left out, as are links of a node with itself and links with a null.
    """
    found = ties(edges)
    return found.union(found.select(F.col("root").alias("node"), "root").distinct())
