from collections import Counter

import pytest
from data import TINY, edges, random_rows, table, undirected

from edgeworks.operators import graph
from edgeworks.operators.graph import Graph


def test_tiny_degrees(spark):
    e = edges(spark, TINY)
    assert table(graph.degrees(e)) == [(1, 3), (2, 3), (3, 3), (4, 1)]
    assert table(graph.graph_stats(e)) == [(4, 5, 3)]
    assert table(graph.graph_counts(Graph.from_edges(e))) == [(4, 5)]
    assert table(graph.degree_distribution(e)) == [(1, 1), (3, 3)]


def test_self_loop_adds_two(spark):
    assert table(graph.degrees(edges(spark, [(1, 1), (1, 2)]))) == [(1, 3), (2, 1)]


def test_empty_graph(spark):
    none = edges(spark, [])
    assert table(graph.vertices_of(none)) == []
    assert table(graph.graph_stats(none)) == [(0, 0, 0)]
    assert table(graph.max_degree(none)) == [(0,)]
    assert table(graph.find_vertex_report(Graph.from_edges(none), 1)) == [("User ID 1 not found in the dataset.",)]


def test_lookup_and_neighbours(spark):
    e = edges(spark, TINY)
    g = Graph.from_edges(e)
    assert table(graph.find_vertex_report(g, 4)) == [("User ID 4 found in the dataset.",)]
    assert table(graph.find_vertex(g.vertices, 9)) == []
    assert table(graph.incident_edges(e, 3)) == [(1, 3), (2, 3), (3, 4)]
    assert table(graph.neighbor_ids(e, 2)) == [(1,), (1,), (3,)]
    wanted = spark.createDataFrame([(4,), (9,)], "id bigint")
    assert table(graph.find_vertices_report(g, wanted)) == [
        (4, "User ID 4 found in the dataset."), (9, "User ID 9 not found in the dataset.")]


def test_lookup_filter_reaches_the_scan(spark, path):
    edges(spark, TINY).write.parquet(path)
    plan = graph.incident_edges(spark.read.parquet(path), 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(src,3),EqualTo(dst,3))]" in plan


@pytest.mark.parametrize("seed", range(3))
def test_canonical_edges(spark, seed):
    rows = random_rows(seed)
    assert table(graph.canonical_edges(edges(spark, rows))) == undirected(rows)
    upper = Counter((a, b) for a, b in rows if a < b)
    assert Counter(table(graph.canonical_edges(edges(spark, rows), mode="upper"))) == upper


def test_valid_edges(spark):
    assert table(graph.valid_edges(edges(spark, [(1, None), (None, 2), (1, 2)]))) == [(1, 2)]


@pytest.mark.parametrize("hot", [None, 1])
def test_edges_from(spark, hot):
    rows = random_rows(5)
    wanted = spark.createDataFrame([(0,), (3,), (3,), (99,)], "id bigint")
    got = table(graph.edges_from(edges(spark, rows), wanted, min_hot_rows=hot))
    assert got == sorted(r for r in rows if r[0] in (0, 3))


def test_sample_does_not_depend_on_partitions(spark):
    e = edges(spark, random_rows(1, vertices=400, count=900))
    one = graph.sample_vertices(Graph.from_edges(e), 0.3, seed=4)
    other = graph.sample_vertices(Graph.from_edges(e.repartition(7)), 0.3, seed=4)
    assert table(one) == table(other)
    assert 0.2 < one.count() / graph.vertices_of(e).count() < 0.4
