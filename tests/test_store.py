"""Stored graphs: the rows of plain lookups, from a share of the files and row groups."""

import pytest
from data import TINY, edges, random_rows

from edgeworks.operators import graph
from edgeworks.operators.store import EdgeStore


def same(a, b):
    """Equal rows, nulls among them."""
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def scanned(df):
    """``(files, rows)`` that the scans of an executed DataFrame gave out."""
    df.collect()
    files = rows = 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            files += node.metrics().apply("numFiles").value()
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return files, rows


@pytest.mark.parametrize("rows", [TINY, random_rows(3), [(None, 1), (1, None), (1, 1), (1, 1), (None, None)], []])
def test_lookups_give_the_rows_of_a_full_scan(spark, path, rows):
    plain = edges(spark, rows)
    store = EdgeStore.write(plain, path, files=3)
    again = EdgeStore(spark, path)
    assert same(again.edges(), plain)
    for vertex in (1, 999):
        for name in ("incident_edges", "neighbor_ids", "incident_count"):
            want = getattr(graph, name)(plain, vertex)
            assert same(getattr(store, name)(vertex), want), (name, vertex)
        want = graph.find_vertex_report(graph.Graph.from_edges(plain), vertex)
        assert same(store.find_vertex_report(vertex), want)


def test_text_ids_other_columns_and_many_copies(spark, path):
    rows = [("a", "b", 1.5)] * 25_001 + [("a", "b", 2.5), ("c", "a", None), ("c", "a", None)]
    store = EdgeStore.write(spark.createDataFrame(rows, "src string, dst string, `the score` double"), path)
    assert store.incident_count("a").collect()[0].edges == len(rows)
    found = store.incident_edges("a").groupBy("src", "dst", "the score").count().collect()
    assert sorted((r.src, r[2] or 0, r["count"]) for r in found) == [("a", 1.5, 25_001), ("a", 2.5, 1), ("c", 0, 2)]
    with pytest.raises(ValueError, match="edge_copies"):
        EdgeStore.write(spark.createDataFrame([(1, 2, 3)], "src int, dst int, edge_copies int"), path + "2")


def test_a_lookup_reads_a_share_of_files_and_row_groups(spark, path):
    n = 400_000
    plain = spark.range(n).selectExpr("(id * 7919) % 20011 AS src", "100000 + (id * 104729) % 30011 AS dst")
    store = EdgeStore.write(plain, path, files=8, group_bytes=64 << 10)
    one = store.incident_edges(4321)
    files, rows = scanned(one)
    assert one.count() == plain.filter("src = 4321").count() > 0
    # One file holds an eighth; of its row groups the vertex needs few.
    assert files <= 2 and rows < n / 16
    plain.coalesce(1).write.parquet(path + "-plain")
    assert scanned(graph.incident_edges(spark.read.parquet(path + "-plain"), 4321))[1] == n


def test_the_edges_of_a_hub_are_divided(spark, path):
    plain = spark.range(60_000).selectExpr("IF(id % 3 = 0, 5, id) AS src", "id AS dst")
    store = EdgeStore.write(plain, path, files=12)
    index = spark.read.parquet(f"{path}/index_src")
    assert index.filter("low <= 5 AND high >= 5").count() >= 3
    assert store.incident_count(5).collect()[0].edges == graph.incident_count(plain, 5).collect()[0].edges
