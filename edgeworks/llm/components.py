"""Connected components of undirected links, by stars that are cut smaller and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import Workspace


def _sum() -> Column:
    return F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's least neighbour instead."""
    both = links.select("node", "root").union(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    least = least.select(F.col("node").alias("of"), F.least("node", "least").alias("least"))
    larger = both.filter(F.col("root") > F.col("node"))
    return larger.join(least, F.col("node") == F.col("of")).select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to the least of them."""
    least = links.groupBy("node").agg(F.min("root").alias("least")).withColumnRenamed("node", "of")
    moved = links.join(least, F.col("node") == F.col("of")).filter(F.col("root") != F.col("least"))
    return moved.select(F.col("root").alias("node"), F.col("least").alias("root")).union(least.select(F.col("of").alias("node"), F.col("least").alias("root"))).distinct()


def components(work: Workspace, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for each node of ``links`` but the roots; a root is the least node of its component.

    Rounds grow with the logarithm of the number of nodes. Each round's links
    are written to the shared folder, so a lost executor costs one round.
    """
    state, seen = work.keep(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct(), "links", sum=_sum())
    while seen["rows"]:
        before, old = state, seen
        state, seen = work.keep(_small_star(_large_star(state)), "stars", sum=_sum())
        work.drop(before)
        if (old["rows"], old["sum"]) == (seen["rows"], seen["sum"]):
            break
    return state
