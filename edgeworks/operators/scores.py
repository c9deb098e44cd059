"""Scored links ``src, dst, score``: means and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.functions import greatest_mean
from edgeworks.loop import Workspace
from edgeworks.operators.graph import endpoints, hot_vertices
from edgeworks.operators.skew import hot_keys, spread_join


def vertex_mean_score(links: DataFrame) -> DataFrame:
    """``id, avg_score``: mean score of the links at each vertex."""
    return endpoints(links, "score").groupBy("id").agg(F.avg("score").alias("avg_score"))


def mean_score(links: DataFrame) -> DataFrame:
    """The mean of all scores as ``avg_score``; 0 without links."""
    return links.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("avg_score"))


def filter_score(links: DataFrame, min_score: float) -> DataFrame:
    """Links with ``score >= min_score``."""
    return links.filter(F.col("score") >= F.lit(min_score))


def filter_above_mean(links: DataFrame) -> DataFrame:
    """Links with a score at or above the mean of all links."""
    return links.filter(F.col("score") >= mean_score(links).scalar())


def filter_above_endpoint_means(
    links: DataFrame, means: DataFrame | None = None, min_hot_rows: int | None = None
) -> DataFrame:
    """Links with a score strictly above the mean of both their endpoints.

    The means are looked up by two joins; links of a hub are divided over
    tasks. A vertex without a mean counts as 0.
    """
    if means is None:
        # One pass over the links tells the means and which vertices are hot.
        per_vertex = endpoints(links, "score").groupBy("id").agg(
            F.avg("score").alias("avg_score"), F.count(F.lit(1)).alias("degree"))
        means, _ = Workspace(links.sparkSession).keep(per_vertex, "means")
        hot = hot_keys(means, "id", min_rows=min_hot_rows, count="degree")
    else:
        hot = hot_vertices(links, min_rows=min_hot_rows)
    rated = links
    for side in ("src", "dst"):
        mean = means.select(F.col("id").alias(side), F.col("avg_score").alias(f"{side}_mean"))
        rated = spread_join(rated, mean, side, hot, by=None, how="left")
    above = F.col("score") > greatest_mean("src_mean", "dst_mean")
    return rated.filter(above).select(*links.columns)
