"""Graphs as two DataFrames: vertices, lookups, neighbours, degrees, samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.functions import found_message, other_end, uniform
from edgeworks.operators.skew import hot_keys, spread_join


def endpoints(edges: DataFrame, *carry: str) -> DataFrame:
    """Both endpoint columns as rows ``id``, with the columns to carry along."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id"), *carry)


def vertices_of(edges: DataFrame) -> DataFrame:
    """Distinct endpoints as ``id``, from one scan of the edges."""
    return endpoints(edges).distinct()


@dataclass(frozen=True)
class Graph:
    """``vertices`` has ``id``; ``edges`` has ``src, dst`` and is directed.

    ``derived`` says that the vertices are just the endpoints of the edges, so
    that an operator may take them from its own, smaller copy of the edges.
    """

    vertices: DataFrame
    edges: DataFrame
    derived: bool = False

    @classmethod
    def from_edges(cls, edges: DataFrame, default: int | None = None) -> Graph:
        """Vertices are the endpoints; ``default`` gives each a ``value``."""
        vertices = vertices_of(edges)
        if default is not None:
            vertices = vertices.withColumn("value", F.lit(default))
        return cls(vertices, edges, derived=True)


def valid_edges(edges: DataFrame) -> DataFrame:
    """Edges with both ends present."""
    return edges.dropna(subset=["src", "dst"])


def canonical_edges(edges: DataFrame, mode: str = "canonical") -> DataFrame:
    """One row ``src < dst`` per undirected edge, self-loops left out.

    ``mode="upper"`` only keeps the rows with ``src < dst`` as they stand, for
    files that hold both directions.
    """
    if mode == "upper":
        return edges.filter("src < dst")
    pairs = edges.filter("src != dst").select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return pairs.distinct()


def find_vertex(vertices: DataFrame, vertex) -> DataFrame:
    """The vertex with an id, or no row."""
    return vertices.filter(F.col("id") == F.lit(vertex))


def find_vertex_report(graph: Graph, vertex) -> DataFrame:
    """One line ``message``: the vertex is, or is not, in the graph.

    Where the vertices are the ends of the edges, an endpoint test answers
    this, so the vertex set is not built.
    """
    hit = (F.col("src") == F.lit(vertex)) | (F.col("dst") == F.lit(vertex))
    rows = graph.edges.filter(hit) if graph.derived else find_vertex(graph.vertices, vertex)
    found = rows.agg((F.count(F.lit(1)) > 0).alias("found"))
    return found.select(found_message(F.lit(vertex), F.col("found")).alias("message"))


def find_vertices_report(graph: Graph, wanted: DataFrame) -> DataFrame:
    """``id, message`` for a table of wanted ids, in one join."""
    known = graph.vertices.select("id", F.lit(True).alias("found"))
    looked = wanted.select("id").distinct().join(known, "id", "left")
    return looked.select("id", found_message(F.col("id"), F.coalesce("found", F.lit(False))).alias("message"))


def incident_edges(edges: DataFrame, vertex) -> DataFrame:
    """Edges with the vertex at either end."""
    return edges.filter((F.col("src") == F.lit(vertex)) | (F.col("dst") == F.lit(vertex)))


def neighbor_ids(edges: DataFrame, vertex) -> DataFrame:
    """The other end ``id`` of every incident edge; parallel edges repeat it."""
    return incident_edges(edges, vertex).select(other_end(F.lit(vertex)).alias("id"))


def incident_count(edges: DataFrame, vertex) -> DataFrame:
    """Number of incident edges as ``edges``."""
    return incident_edges(edges, vertex).agg(F.count(F.lit(1)).alias("edges"))


def graph_counts(graph: Graph) -> DataFrame:
    """``vertices, edges`` in one row; one pass where the vertices are the ends of the edges."""
    if graph.derived:
        return graph_stats(graph.edges).select("vertices", "edges")
    n_vertices = graph.vertices.agg(F.count(F.lit(1))).scalar()
    return graph.edges.agg(F.count(F.lit(1)).alias("edges")).select(n_vertices.alias("vertices"), "edges")


def degrees(edges: DataFrame) -> DataFrame:
    """``id, degree``: both ends of every row count, so a self-loop adds 2."""
    return endpoints(edges).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def hot_vertices(edges: DataFrame, min_rows: int | None = None) -> DataFrame | None:
    """Vertices at an end of a large share of the edges, see ``skew``."""
    return hot_keys(endpoints(edges), "id", min_rows=min_rows)


def max_degree(edges: DataFrame) -> DataFrame:
    """The largest degree as ``delta``; 0 without edges."""
    return degrees(edges).agg(F.coalesce(F.max("degree"), F.lit(0)).alias("delta"))


def graph_stats(edges: DataFrame) -> DataFrame:
    """``vertices, edges, delta`` in one row.

    All three follow from the degrees: each row of the edge list adds 2.
    """
    return degrees(edges).agg(
        F.count(F.lit(1)).alias("vertices"),
        F.coalesce((F.sum("degree") / 2).cast("bigint"), F.lit(0)).alias("edges"),
        F.coalesce(F.max("degree"), F.lit(0)).alias("delta"),
    )


def degree_distribution(edges: DataFrame) -> DataFrame:
    """``degree, count``: how many vertices have each degree."""
    return degrees(edges).groupBy("degree").agg(F.count(F.lit(1)).alias("count"))


def link_summary(links: DataFrame) -> DataFrame:
    """``vertices, links``: distinct endpoints and rows of a link table."""
    return graph_counts(Graph.from_edges(links)).withColumnRenamed("edges", "links")


def sample_vertices(graph: Graph, fraction: float, seed: int = 0) -> DataFrame:
    """A Bernoulli sample of the vertices, the same for the same seed."""
    return graph.vertices.filter(uniform(f"vertex-{seed}", "id") < F.lit(fraction))


def edges_from(
    edges: DataFrame, vertices: DataFrame, side: str = "src", min_hot_rows: int | None = None
) -> DataFrame:
    """Edges whose ``side`` is one of the vertices.

    A hub may own a large share of the edges, so its edges are divided.
    """
    hot = hot_keys(edges, side, min_rows=min_hot_rows)
    keep = vertices.select(F.col("id").alias(side)).distinct()
    return spread_join(edges, keep, side, hot, by=None, how="left_semi").select(*edges.columns)
