"""Queries over graphs: lookups, degrees, rank, communities, triangles."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeworks.operators import community, graph, rank, triangles
from edgeworks.operators.graph import Graph
from edgeworks.operators.tables import ordered, top_k
from edgeworks.plans import rounds
from edgeworks.plans.inputs import (
    ORDER_PARTS,
    PART_LINKS,
    SALES,
    USER_EVENTS,
    order_parts,
    part_links,
    sales_edges,
    table,
    user_events,
)
from edgeworks.plans.registry import query

ENDS = "SELECT src AS id FROM part_links UNION ALL SELECT dst FROM part_links"
DEGREE = f"""{PART_LINKS}, degree AS (
  SELECT id, count(*) AS degree FROM ({ENDS}) GROUP BY id)"""


@query("vertices", f"WITH {PART_LINKS} SELECT DISTINCT id FROM ({ENDS})")
def _(spark, d):
    return graph.vertices_of(part_links(spark, d))


@query("vertices_with_value", f"WITH {PART_LINKS} SELECT DISTINCT id, 1 AS value FROM ({ENDS})")
def _(spark, d):
    return Graph.from_edges(part_links(spark, d), default=1).vertices


@query("degrees", f"WITH {DEGREE} SELECT id, degree FROM degree")
def _(spark, d):
    return graph.degrees(part_links(spark, d))


@query("max_degree", f"WITH {DEGREE} SELECT max(degree) AS delta FROM degree")
def _(spark, d):
    return graph.max_degree(part_links(spark, d))


@query("degree_distribution", f'WITH {DEGREE} SELECT degree, count(*) AS "count" FROM degree GROUP BY degree')
def _(spark, d):
    return graph.degree_distribution(part_links(spark, d))


@query("graph_stats", f"""WITH {DEGREE} SELECT count(*) AS vertices,
  (SELECT count(*) FROM part_links) AS edges, max(degree) AS delta FROM degree""")
def _(spark, d):
    return graph.graph_stats(part_links(spark, d))


@query("graph_counts", f"""WITH {PART_LINKS} SELECT
  (SELECT count(DISTINCT id) FROM ({ENDS})) AS vertices, (SELECT count(*) FROM part_links) AS edges""")
def _(spark, d):
    return graph.graph_counts(Graph.from_edges(part_links(spark, d)))


@query("link_summary", f"""WITH {USER_EVENTS} SELECT
  (SELECT count(DISTINCT id) FROM (SELECT src AS id FROM user_events UNION ALL SELECT dst FROM user_events)) AS vertices,
  (SELECT count(*) FROM user_events) AS links""")
def _(spark, d):
    return graph.link_summary(user_events(spark, d))


@query("find_vertex", f"WITH {PART_LINKS} SELECT DISTINCT id FROM ({ENDS}) WHERE id = 'p7'")
def _(spark, d):
    return graph.find_vertex(graph.vertices_of(part_links(spark, d)), "p7")


def _report(vertex):
    return f"""WITH {PART_LINKS} SELECT 'User ID {vertex}' || CASE WHEN count(*) > 0 THEN ' found' ELSE ' not found' END
  || ' in the dataset.' AS message FROM part_links WHERE src = '{vertex}' OR dst = '{vertex}'"""


@query("find_vertex_report", _report("p7"))
def _(spark, d):
    return graph.find_vertex_report(Graph.from_edges(part_links(spark, d)), "p7")


@query("find_vertex_missing", _report("1691593"))
def _(spark, d):
    return graph.find_vertex_report(Graph.from_edges(part_links(spark, d)), "1691593")


@query("find_vertices_report", f"""WITH {USER_EVENTS},
wanted AS (SELECT DISTINCT 'u' || c_custkey AS id FROM customer)
SELECT id, 'User ID ' || id || CASE WHEN id IN (SELECT src FROM user_events) THEN ' found' ELSE ' not found' END
  || ' in the dataset.' AS message FROM wanted""")
def _(spark, d):
    wanted = table(spark, d, "customer").select(F.concat(F.lit("u"), "c_custkey").alias("id"))
    return graph.find_vertices_report(Graph.from_edges(user_events(spark, d)), wanted)


@query("incident_edges", f"WITH {PART_LINKS} SELECT src, dst, score FROM part_links WHERE src = 's3' OR dst = 's3'")
def _(spark, d):
    return graph.incident_edges(part_links(spark, d), "s3")


@query("incident_count", f"WITH {PART_LINKS} SELECT count(*) AS edges FROM part_links WHERE src = 's3' OR dst = 's3'")
def _(spark, d):
    return graph.incident_count(part_links(spark, d), "s3")


@query("neighbor_ids", f"""WITH {PART_LINKS} SELECT CASE WHEN src = 's3' THEN dst ELSE src END AS id
  FROM part_links WHERE src = 's3' OR dst = 's3'""")
def _(spark, d):
    return graph.neighbor_ids(part_links(spark, d), "s3")


@query("canonical_edges", f"WITH {SALES}, {rounds.canonical('sales')} SELECT src, dst FROM pairs")
def _(spark, d):
    return graph.canonical_edges(sales_edges(spark, d))


@query("upper_edges", f"WITH {SALES} SELECT src, dst FROM sales WHERE src < dst")
def _(spark, d):
    return graph.canonical_edges(sales_edges(spark, d), mode="upper")


@query("valid_edges", """SELECT nullif(l_partkey, l_suppkey) AS src, nullif(l_suppkey, l_orderkey) AS dst
  FROM lineitem WHERE l_partkey <> l_suppkey AND l_suppkey <> l_orderkey""")
def _(spark, d):
    gaps = table(spark, d, "lineitem").select(
        F.nullif("l_partkey", "l_suppkey").alias("src"), F.nullif("l_suppkey", "l_orderkey").alias("dst"))
    return graph.valid_edges(gaps)


SAMPLE = f"""{PART_LINKS}, sampled AS (
  SELECT DISTINCT id FROM ({ENDS}) WHERE {rounds.uniform('vertex-0', 'id')} < 0.05)"""


@query("sample_vertices", f"WITH {SAMPLE} SELECT id FROM sampled")
def _(spark, d):
    return graph.sample_vertices(Graph.from_edges(part_links(spark, d)), 0.05)


@query("edges_from_sample", f"WITH {SAMPLE} SELECT src, dst, score FROM part_links WHERE src IN (SELECT id FROM sampled)")
def _(spark, d):
    edges = part_links(spark, d)
    return graph.edges_from(edges, graph.sample_vertices(Graph.from_edges(edges), 0.05))


@query("edges_from", f"""WITH {PART_LINKS} SELECT src, dst, score FROM part_links
  WHERE dst IN (SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def _(spark, d):
    solvent = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("id"))
    return graph.edges_from(part_links(spark, d), solvent, side="dst")


RANKS = f"WITH {SALES}, {rounds.pagerank('sales', 10)}"


def _ranked(spark, d, **options):
    ranks = rank.pagerank(Graph.from_edges(sales_edges(spark, d)), **options)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


@query("pagerank_10", f"{RANKS} SELECT id, round(pagerank, 6) AS pagerank FROM ranks")
def _(spark, d):
    return _ranked(spark, d)


@query("pagerank_ranked", f"{RANKS} SELECT id, round(pagerank, 6) AS pagerank FROM ranks ORDER BY 2 DESC, 1")
def _(spark, d):
    return ordered(_ranked(spark, d), "pagerank", "id")


@query("pagerank_top10", f"{RANKS} SELECT id, round(pagerank, 6) AS pagerank FROM ranks ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, d):
    return top_k(_ranked(spark, d), "pagerank", 10, "id")


@query("pagerank_tol", f"""WITH {SALES}, {rounds.pagerank_until('sales', 1e-4, 70)}
SELECT id, round(pagerank, 6) AS pagerank FROM ranks""")
def _(spark, d):
    return _ranked(spark, d, tol=1e-4)


@query("pagerank_multi_edges", f"""WITH {PART_LINKS}, {rounds.pagerank('part_links', 10)}
SELECT id, round(pagerank, 6) AS pagerank FROM ranks""")
def _(spark, d):
    ranks = rank.pagerank(Graph.from_edges(part_links(spark, d)))
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


@query("label_propagation_5", f"""WITH {ORDER_PARTS}, {rounds.label_propagation('order_parts', 5)}
SELECT id, label FROM l5""")
def _(spark, d):
    return community.label_propagation(Graph.from_edges(order_parts(spark, d)))


@query("labels_by_retraction", f"""WITH {SALES}, {rounds.label_propagation('sales', 8)}
SELECT id, label FROM l8""")
def _(spark, d):
    return community.settling_labels(Graph.from_edges(sales_edges(spark, d)), max_iter=8)[0]


TRIANGLES = f"""{SALES}, {rounds.canonical('sales')},
found AS MATERIALIZED (
  SELECT a.src AS x, a.dst AS y, b.dst AS z FROM pairs a
  JOIN pairs b ON b.src = a.dst JOIN pairs c ON c.src = a.src AND c.dst = b.dst),
counted AS (
  SELECT id, count(*) AS n FROM (
    SELECT x AS id FROM found UNION ALL SELECT y FROM found UNION ALL SELECT z FROM found) GROUP BY id),
degree AS (
  SELECT id, count(*) AS d FROM (SELECT src AS id FROM pairs UNION ALL SELECT dst FROM pairs) GROUP BY id)"""


@query("triangle_count", f"""WITH {TRIANGLES}
SELECT id, coalesce(n, 0) AS "count" FROM degree LEFT JOIN counted USING (id)""")
def _(spark, d):
    return triangles.triangle_count(Graph.from_edges(sales_edges(spark, d)))


@query("clustering_coefficient", f"""WITH {TRIANGLES}
SELECT id, round(CASE WHEN d > 1 THEN 2.0::DOUBLE * coalesce(n, 0) / (d * (d - 1)) ELSE 0.0::DOUBLE END, 6) AS coefficient
FROM degree LEFT JOIN counted USING (id)""")
def _(spark, d):
    found = triangles.clustering_coefficient(Graph.from_edges(sales_edges(spark, d)))
    return found.select("id", F.round("coefficient", 6).alias("coefficient"))
