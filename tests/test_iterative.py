"""Rank, communities, triangles against plain Python and published numbers."""

from collections import Counter, defaultdict
from itertools import combinations

import pytest
from data import PARTS, TINY, edges, random_rows, table, undirected
from pyspark.sql import functions as F

from edgeworks.loop import Workspace
from edgeworks.operators import community, grid, votes
from edgeworks.operators.community import label_propagation, settling_labels
from edgeworks.operators.graph import Graph
from edgeworks.operators.rank import pagerank
from edgeworks.operators.triangles import clustering_coefficient, triangle_count

HOT = pytest.mark.parametrize("hot", [None, 3], ids=["plain", "divided"])


def rank_by_hand(rows, rounds, reset=0.15):
    ids, out = {v for r in rows for v in r}, Counter(a for a, _ in rows)
    rank = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        flow = defaultdict(float)
        for a, b in rows:
            flow[b] += rank[a] / out[a]
        rank = {v: reset + (1 - reset) * flow[v] for v in ids}
    total = sum(rank.values())
    return {v: r * len(ids) / total for v, r in rank.items()}


def labels_by_hand(rows, rounds):
    label = {v: v for r in rows for v in r}
    for _ in range(rounds):
        votes = defaultdict(Counter)
        for a, b in rows:
            votes[a][label[b]] += 1
            votes[b][label[a]] += 1
        label = {v: min(votes[v], key=lambda x: (-votes[v][x], x)) for v in label}
    return label


def triangles_by_hand(rows):
    near = defaultdict(set)
    for a, b in undirected(rows):
        near[a].add(b)
        near[b].add(a)
    count = {v: 0 for r in rows for v in r}
    for v in count:
        count[v] = sum(b in near[a] for a, b in combinations(sorted(near[v]), 2))
    return count, near


@HOT
def test_tiny_rank(spark, hot):
    ranks = dict(table(pagerank(Graph.from_edges(edges(spark, TINY)), min_hot_rows=hot)))
    assert ranks == pytest.approx({1: 0.475940, 2: 0.745640, 3: 1.244584, 4: 1.533836}, abs=1e-6)


@HOT
@pytest.mark.parametrize("rounds", [0, 6])
def test_rank_by_hand(spark, hot, rounds):
    rows = random_rows(11)
    got = dict(table(pagerank(Graph.from_edges(edges(spark, rows)), max_iter=rounds, min_hot_rows=hot)))
    assert got == pytest.approx(rank_by_hand(rows, rounds), abs=1e-9)


@HOT
def test_rank_to_a_tolerance(spark, hot):
    rows = random_rows(12)
    got = dict(table(pagerank(Graph.from_edges(edges(spark, rows)), tol=1e-3, min_hot_rows=hot)))
    assert got == pytest.approx(rank_by_hand(rows, 300), abs=0.02)


@HOT
def test_labels(spark, hot):
    assert table(label_propagation(Graph.from_edges(edges(spark, TINY)), min_hot_rows=hot)) == [
        (1, 2), (2, 1), (3, 1), (4, 1)]
    rows = random_rows(13)
    got = dict(table(label_propagation(Graph.from_edges(edges(spark, rows)), max_iter=3, min_hot_rows=hot)))
    assert got == labels_by_hand(rows, 3)


@HOT
@pytest.mark.parametrize("few", [0.0, 0.5, 1.0])
def test_labels_by_retraction(spark, hot, few):
    rows = random_rows(13)
    got, told = settling_labels(Graph.from_edges(edges(spark, rows)), max_iter=6, few=few, min_hot_rows=hot)
    assert dict(table(got)) == labels_by_hand(rows, 6)
    assert len(told) <= 6


def test_fewer_messages_as_labels_settle(spark):
    # Two dense groups and a path between them, with copies.
    rows = [(a, b) for a, b in combinations(range(12), 2)] + [(a, b) for a, b in combinations(range(20, 32), 2)]
    rows += [(11, 40), (40, 41), (41, 42), (42, 43), (43, 20), (0, 1), (0, 1)]
    got, told = settling_labels(Graph.from_edges(edges(spark, rows)), max_iter=30)
    assert dict(table(got)) == labels_by_hand(rows, len(told))
    few = [t for t in told if t["sent"] <= 7]
    # Each label that changed takes a vote and adds one at a neighbour, at most 13 here.
    assert few and all(t["messages"] <= 2 * 13 * t["sent"] for t in few) and few[-1]["messages"] < told[0]["messages"] / 10
    assert told[-1]["changed"] == 0
    assert table(settling_labels(Graph.from_edges(edges(spark, [])))[0]) == []


@pytest.mark.parametrize("few", [0.0, 0.25, 1.0])
@pytest.mark.parametrize("kind", ["bigint", "int"])
def test_label_rounds_write_no_row_for_a_vote(spark, monkeypatch, few, kind):
    # Copies, loops, both directions and null ends; several parts, slices and chunks of links.
    rows = random_rows(17) + [(5, 5), (5, 5), (None, 3), (4, None), (None, None), (1000, None)]
    graph = Graph.from_edges(spark.createDataFrame(rows, f"src {kind}, dst {kind}"))
    for module, name, value in ((grid, "SMALL_BLOCK", 20), (grid, "CHUNK", 7), (votes, "CHUNK", 7), (votes, "SLICE_LINKS", 25)):
        monkeypatch.setattr(module, name, value)
    monkeypatch.setattr(grid, "pays", lambda *sizes: True)
    written, keep = [], Workspace.keep

    def kept(self, df, name="step", **metrics):
        written.append(name)
        return keep(self, df, name, **metrics)

    monkeypatch.setattr(Workspace, "keep", kept)
    got, told = settling_labels(graph, max_iter=6, few=few)
    assert "votes" not in written and "corrections" not in written
    want, said = community._by_routes(graph, 6, few, None)
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr) and got.schema == want.schema
    assert [(t["sent"], t["changed"]) for t in told] == [(t["sent"], t["changed"]) for t in said]


def test_isolated_vertices_keep_their_state(spark):
    e = edges(spark, [(1, 2)])
    g = Graph(spark.createDataFrame([(1,), (2,), (7,)], "id bigint"), e)
    assert dict(table(label_propagation(g)))[7] == 7
    assert dict(table(triangle_count(g)))[7] == 0
    assert set(dict(table(pagerank(g)))) == {1, 2, 7}


@HOT
@pytest.mark.parametrize("seed", [21])
def test_triangles_by_hand(spark, hot, seed):
    rows = random_rows(seed)
    g = Graph.from_edges(edges(spark, rows))
    count, near = triangles_by_hand(rows)
    assert dict(table(triangle_count(g, min_hot_rows=hot))) == count
    share = {v: 2 * count[v] / (len(near[v]) * (len(near[v]) - 1)) if len(near[v]) > 1 else 0.0 for v in count}
    assert dict(table(clustering_coefficient(g, min_hot_rows=hot))) == pytest.approx(share)


@pytest.mark.parametrize("cell", [1, 20, 10_000])
def test_triangles_in_cells_of_any_size(spark, monkeypatch, cell):
    """One hub next to most vertices, with and without lists of its own, and cells from one colour to many."""
    from edgeworks.operators import triangles

    monkeypatch.setattr(triangles, "LOOKED_UP", 7)
    rows = random_rows(25, vertices=40, count=200) + [(0, v) for v in range(1, 30)] + [(1, v) for v in range(2, 40)]
    g = Graph.from_edges(edges(spark, rows))
    want = triangles_by_hand(rows)[0]
    for hot in (None, 10, 10_000):
        assert dict(table(triangle_count(g, min_hot_rows=hot, cell_edges=cell))) == want, hot


def test_edges_go_to_as_many_cells_as_there_are_colours(spark):
    from edgeworks.operators.triangles import colour_cells, colours_for

    assert [colours_for(e, 8) for e in (0, 10, 10**6, 10**8, 10**12)] == [1, 1, 4, 18, 1733]
    assert colours_for(10**9, 4000) == 55
    cells = table(colour_cells(edges(spark, undirected(random_rows(26))), 5))
    assert len(cells) == 5 * len(undirected(random_rows(26))) == len(set(cells))
    for cell, _, _, a, b in cells:
        colours = [cell // 25, cell // 5 % 5, cell % 5]
        assert colours == sorted(colours)
        colours.remove(a)
        assert b in colours


def test_string_ids(spark):
    rows = [(f"v{a}", f"v{b}") for a, b in random_rows(23)]
    g = Graph.from_edges(edges(spark, rows, "string"))
    assert dict(table(triangle_count(g))) == triangles_by_hand(rows)[0]
    assert dict(table(label_propagation(g, max_iter=2))) == labels_by_hand(rows, 2)


def test_rank_moves_the_links_once(spark):
    """Inside a block of rounds only ranks are shuffled, never the links."""
    from edgeworks.operators import rank
    from edgeworks.operators.routes import routes_over

    g = Graph.from_edges(edges(spark, random_rows(24)))
    with routes_over(rank.links_of(g), g) as routes:
        state = g.vertices.select("id", F.lit(1.0).alias("rank")).repartition(PARTS, "id").persist()
        state.count()
        sent = routes.deliver(state).groupBy("dst").agg(F.sum("rank"))
        sent.collect()
        plan = sent._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    state.unpersist()


@pytest.mark.parametrize("kind", ["bigint", "int", "string", "double"])
def test_blocks_of_edges_are_small_and_give_every_triangle(spark, kind):
    """An edge travels in a packed block, as few bytes, and ids of any type come back as they were."""
    from edgeworks.operators.triangles import BLOCK, _packer

    rows = random_rows(31, vertices=60, count=600)
    as_id = {"string": "ä{}".format, "double": lambda x: x / 3}.get(kind, int)
    named = [(as_id(a), as_id(b)) for a, b in rows]
    g = Graph.from_edges(edges(spark, named, kind))
    want = {as_id(x): n for x, n in triangles_by_hand(rows)[0].items()}
    assert dict(table(triangle_count(g, cell_edges=40, min_hot_rows=50))) == want

    dense = [(a, 10**9 + b, 0, 1) for a in range(100) for b in range(a, a + 100)]
    packed = spark.createDataFrame(dense, f"src {kind}, dst {kind}, a int, b int") if kind in ("bigint", "int") else None
    if packed is not None:
        block = packed.groupBy("a", "b").applyInArrow(_packer(), BLOCK).first()
        assert block["n_first"] == 100 and len(block["edges"]) + len(block["ids"]) < 4 * len(dense)


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("tol", [None, 0.1], ids=["rounds", "tolerance"])
def test_rank_of_a_dense_graph_sends_arrays(spark, monkeypatch, kind, tol):
    """With a row for each message a round's shuffle grew to one row a link."""
    from edgeworks.operators import grid, rank

    rows = [(a, b) for a, b in random_rows(19, vertices=30, count=400)] + [(0, 1)] * 5 + [(7, 99), (99, 99)]
    text = [(str(a), str(b)) for a, b in rows]
    e = spark.createDataFrame(rows if kind == "bigint" else text, f"src {kind}, dst {kind}")
    monkeypatch.setattr(grid, "pays", lambda *_: False)
    want = dict(table(pagerank(Graph.from_edges(e), tol=tol)))
    assert len(want) == 31
    monkeypatch.undo()
    # Many parts, chunks and pieces of blocks.
    for name, value in (("CHUNK", 50), ("BLOCK_LINKS", 30), ("parts_for", lambda *_: 2), ("pays", lambda *_: True)):
        monkeypatch.setattr(grid, name, value)
    monkeypatch.setattr(rank, "routes_over", None)
    assert dict(table(pagerank(Graph.from_edges(e), tol=tol))) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("options", [{"max_iter": 2}, {"max_iter": 0}, {"tol": 0.1}], ids=str)
@pytest.mark.parametrize("rows", [
    [(1, 2), (1, 2), (2, 1), (2, None), (1, 3), (3, 1)], [(1, 2), (2, 1), (None, 1), (None, None), (None, 3)]], ids=["to", "from"])
def test_rank_with_null_ends_is_that_of_the_routes(spark, monkeypatch, options, rows):
    from edgeworks.operators import grid

    found = []
    for pays in (False, True):
        monkeypatch.setattr(grid, "pays", lambda *_, pays=pays: pays)
        ranks = pagerank(Graph.from_edges(spark.createDataFrame(rows, "src bigint, dst bigint")), **options)
        found.append({r["id"]: r["pagerank"] for r in ranks.collect()})
    assert found[0] == pytest.approx(found[1], abs=1e-9)


def test_what_a_round_sends_does_not_grow_with_the_links(spark):
    from edgeworks.operators import grid

    assert grid.parts_for(96_000_000, 2_160_000, 12) == grid.parts_for(576_000_000, 12_960_000, 12) == 4
    assert grid.pays(96_000_000, 2_160_000, 4) and not grid.pays(2_000, 1_500, 1)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_cells_are_closed_in_passes(spark, monkeypatch, kind):
    """All copies of the edges lay on disk at once; now those of a share of the cells do."""
    from edgeworks.operators import triangles

    as_id = str if kind == "string" else int
    rows = random_rows(44, vertices=40, count=250)
    g = Graph.from_edges(edges(spark, [(as_id(a), as_id(b)) for a, b in rows], kind))
    count, near = triangles_by_hand(rows)
    passes, keep = [], triangles.Workspace.keep
    monkeypatch.setattr(triangles.Workspace, "keep", lambda work, df, name="step", **kw: (
        passes.append(name), keep(work, df, name, **kw))[1])
    monkeypatch.setattr(triangles, "COPIED_EDGES", 500)
    assert dict(table(triangle_count(g, cell_edges=40, min_hot_rows=1000))) == {as_id(x): n for x, n in count.items()}
    assert passes.count("credits") > 2 and "degrees" not in passes
    shares = dict(table(clustering_coefficient(g, cell_edges=40, min_hot_rows=1000)))
    for x, n in count.items():
        pairs = len(near[x]) * (len(near[x]) - 1)
        assert shares[as_id(x)] == pytest.approx(2 * n / pairs if pairs else 0.0)
