"""Known numbers of well-known small graphs."""

import networks
import pytest
from data import edges
from pyspark.sql import functions as F

from edgeworks.operators import matching
from edgeworks.operators.graph import Graph, graph_stats
from edgeworks.operators.rank import pagerank
from edgeworks.operators.triangles import clustering_coefficient, triangle_count


@pytest.mark.parametrize("name", networks.KNOWN)
def test_known_network(spark, name):
    pairs, vertices, delta, triangles, clustering = networks.KNOWN[name]
    rows = edges(spark, pairs)
    g = Graph.from_edges(rows)
    assert tuple(graph_stats(rows).first()) == (vertices, len(pairs), delta)
    assert (triangle_count(g).agg(F.sum("count")).first()[0] or 0) == 3 * triangles
    found = clustering_coefficient(g)
    column = [c for c in found.columns if c != "id"][-1]
    assert found.agg(F.sum(column)).first()[0] / vertices == pytest.approx(clustering, abs=1e-6)
    chosen = matching.greedy_matching(rows)
    assert matching.validate_matching(chosen).isEmpty() and matching.validate_maximal(chosen, rows).isEmpty()


def test_regular_graphs_rank_evenly(spark):
    ring = [(i, (i + 1) % 12) for i in range(12)]
    ranks = pagerank(Graph.from_edges(edges(spark, ring))).select("pagerank").collect()
    assert [r[0] for r in ranks] == pytest.approx([1.0] * 12)
