"""Queries over scored links and matchings."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeworks.functions import vertex_part
from edgeworks.loop import kept_wide, wide_shuffles
from edgeworks.operators import matching, scores
from edgeworks.operators.graph import canonical_edges, endpoints, hot_vertices, max_degree, vertices_of
from edgeworks.plans import rounds
from edgeworks.plans.inputs import (
    PART_LINKS,
    SALES,
    SCORED_PAIRS,
    part_links,
    sales_edges,
    scored_pairs,
    table,
)
from edgeworks.plans.registry import query

SEED = 0

# ---- scores

MEANS = f"""{SCORED_PAIRS}, means AS (
  SELECT id, avg(score) AS m FROM (
    SELECT src AS id, score FROM scored_pairs UNION ALL SELECT dst, score FROM scored_pairs) GROUP BY id)"""
ABOVE = """above AS (
  SELECT l.* FROM {links} l JOIN means a ON l.src = a.id JOIN means b ON l.dst = b.id
  WHERE l.score > greatest(a.m, b.m))"""


@query("vertex_mean_score", f"WITH {MEANS} SELECT id, round(m, 6) AS avg_score FROM means")
def _(spark, d):
    means = scores.vertex_mean_score(scored_pairs(spark, d))
    return means.select("id", F.round("avg_score", 6).alias("avg_score"))


@query("mean_score", f"WITH {SCORED_PAIRS} SELECT round(avg(score), 6) AS avg_score FROM scored_pairs")
def _(spark, d):
    return scores.mean_score(scored_pairs(spark, d)).select(F.round("avg_score", 6).alias("avg_score"))


@query("links_min_score", f"WITH {SCORED_PAIRS} SELECT src, dst, score FROM scored_pairs WHERE score >= 40")
def _(spark, d):
    return scores.filter_score(scored_pairs(spark, d), 40)


@query("links_above_mean", f"""WITH {SCORED_PAIRS} SELECT src, dst, score FROM scored_pairs
  WHERE score >= (SELECT avg(score) FROM scored_pairs)""")
def _(spark, d):
    return scores.filter_above_mean(scored_pairs(spark, d))


@query("links_above_endpoint_means", f"""WITH {MEANS}, {ABOVE.format(links='scored_pairs')}
SELECT src, dst, score FROM above""")
def _(spark, d):
    return scores.filter_above_endpoint_means(scored_pairs(spark, d))


# ---- parts of a matching

QUEUE = f"{SALES}, {rounds.prioritised('sales', SEED)}"
FIRST = f"{QUEUE}, {rounds.greedy('queue', 'g', 1)}"


def _params(k_rounding):
    return f"""WITH {SALES}, {rounds.params('sales', k_rounding)}
SELECT delta, round(p, 9) AS p, k, max_rounds FROM params"""


@query("matching_params", _params("floor"))
def _(spark, d):
    row = matching.matching_params(sales_edges(spark, d))
    return row.withColumn("p", F.round("p", 9))


@query("matching_params_ceil", _params("ceil"))
def _(spark, d):
    row = matching.matching_params(sales_edges(spark, d), k_rounding="ceil")
    return row.withColumn("p", F.round("p", 9))


@query("sample_edges", f"""WITH {PART_LINKS} SELECT src, dst, score FROM part_links
  WHERE {rounds.uniform('edge-0-1', 'src', 'dst')} < 0.1""")
def _(spark, d):
    return matching.sample_edges(part_links(spark, d), 0.1, seed=0, round=1)


@query("same_part_edges", f"""WITH {PART_LINKS} SELECT src, dst, score FROM part_links
  WHERE {rounds.hash60('part-0', 'src')} % 3 = {rounds.hash60('part-0', 'dst')} % 3""")
def _(spark, d):
    return matching.same_part(part_links(spark, d), 3, seed=0)


def _queue(spark, d):
    """The edges in their random order, written once; each line item makes three."""
    queue = matching.with_priority(canonical_edges(sales_edges(spark, d)), SEED)
    return kept_wide(queue, 3 * table(spark, d, "lineitem").count(), "queue")


def _residual(queue):
    """What one round of choices leaves."""
    gone, n = endpoints(matching.mutual_edges(queue)), queue.count()
    with wide_shuffles(queue.sparkSession, 2 * n):
        hot = hot_vertices(queue)
    return kept_wide(matching.residual_edges(queue, gone, hot), n, "residual")


@query("mutual_edges", f"WITH {FIRST} SELECT src, dst FROM g_chosen")
def _(spark, d):
    return matching.mutual_edges(_queue(spark, d))


@query("matched_vertices", f"WITH {FIRST} SELECT src AS id FROM g_chosen UNION SELECT dst FROM g_chosen")
def _(spark, d):
    return matching.matched_vertices(matching.mutual_edges(_queue(spark, d)))


@query("residual_edges", f"WITH {FIRST} SELECT src, dst FROM g_left")
def _(spark, d):
    return _residual(_queue(spark, d)).select("src", "dst")


@query("residual_max_degree", f"""WITH {FIRST} SELECT max(n) AS delta FROM (
  SELECT count(*) AS n FROM (SELECT src AS id FROM g_left UNION ALL SELECT dst FROM g_left) GROUP BY id)""")
def _(spark, d):
    left = _residual(_queue(spark, d))
    return kept_wide(max_degree(left), 2 * left.count(), "delta")


@query("unmatched_edges", f"""WITH {FIRST} SELECT src, dst FROM queue
  WHERE (src, dst) NOT IN (SELECT (src, dst) FROM g_chosen)""")
def _(spark, d):
    queue = _queue(spark, d)
    return matching.unmatched_edges(queue.select("src", "dst"), matching.mutual_edges(queue))


@query("validate_matching", f"""WITH {PART_LINKS} SELECT id, count(*) AS "count" FROM (
  SELECT src AS id FROM part_links UNION ALL SELECT dst FROM part_links) GROUP BY id HAVING count(*) > 1""")
def _(spark, d):
    # The raw links are far from a matching, so there is something to report.
    return matching.validate_matching(part_links(spark, d))


@query("validate_maximal", f"WITH {FIRST} SELECT src, dst FROM g_left")
def _(spark, d):
    # One round of choices is not maximal yet.
    return matching.validate_maximal(matching.mutual_edges(_queue(spark, d)), sales_edges(spark, d))


# ---- whole matchings

GREEDY = f"{QUEUE}, {rounds.greedy('queue', 'g', 20)}"


@query("maximal_matching_greedy", f"WITH {GREEDY} SELECT src, dst, round FROM g_chosen")
def _(spark, d):
    return matching.greedy_matching(sales_edges(spark, d), seed=SEED)


@query("matching_size", f"WITH {GREEDY} SELECT count(*) AS edges FROM g_chosen")
def _(spark, d):
    return matching.matching_size(matching.greedy_matching(sales_edges(spark, d), seed=SEED))


@query("maximal_matching_pairs", f"""WITH {SCORED_PAIRS}, {rounds.prioritised('scored_pairs', SEED)},
{rounds.greedy('queue', 'g', 12)} SELECT src, dst, round FROM g_chosen""")
def _(spark, d):
    return matching.greedy_matching(scored_pairs(spark, d), seed=SEED)


@query("mpc_round", f"""WITH {SALES}, {rounds.params('sales')}, {rounds.prioritised('sales', SEED)},
{rounds.sample('queue', 's', SEED, 1)}, {rounds.greedy('s', 'g', 10, label=1)}
SELECT src, dst, round FROM g_chosen""")
def _(spark, d):
    edges = sales_edges(spark, d)
    row = matching.matching_params(edges).first()
    return matching.mpc_round(edges, row["p"], row["k"], round=1, seed=SEED)


@query("maximal_matching_mpc", f"""WITH {SALES}, {rounds.mpc('sales', SEED, 3, 8, 20)}
SELECT src, dst, round FROM matching""")
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), rounds=3, seed=SEED)


@query("maximal_matching_half", f"""WITH {SALES}, {rounds.mpc('sales', SEED, 3, 14, 10, fixed='0.5 AS p, 1 AS k')}
SELECT src, dst, round FROM matching""")
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), p=0.5, k=1, rounds=3, seed=SEED)


HALF = "0.5 AS p, 1 AS k"


def _until(source, tables, limit, stop, most, inner, sweep, **options):
    return f"""WITH {tables}, {rounds.mpc_until(source, SEED, limit, stop, most, inner, sweep, **options)}
SELECT src, dst, round FROM matching"""


@query("maximal_matching_log_delta", _until("scored_pairs", SCORED_PAIRS, "log_delta", "empty", 40, 6, 8))
def _(spark, d):
    # All settings as they are by default.
    return matching.maximal_matching(scored_pairs(spark, d), seed=SEED)


@query("maximal_matching_log_edges", _until("sales", SALES, "log_edges", "empty", 16, 6, 20))
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), rounds="log_edges", seed=SEED)


@query("maximal_matching_log_edges_p", _until("sales", SALES, "log_edges_p", "empty", 6, 6, 20, k_rounding="ceil"))
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), rounds="log_edges_p", k_rounding="ceil", seed=SEED)


@query("maximal_matching_no_limit", _until("sales", SALES, None, "empty", 12, 12, 1, fixed=HALF))
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), rounds=None, p=0.5, k=1, seed=SEED)


@query("maximal_matching_unchanged", _until("sales", SALES, None, "unchanged", 12, 12, 8, fixed=HALF))
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), rounds=None, stop="unchanged", p=0.5, k=1, seed=SEED)


@query("maximal_matching_degree_one", _until("sales", SALES, None, "degree_one", 12, 12, 8, fixed=HALF))
def _(spark, d):
    return matching.maximal_matching(sales_edges(spark, d), rounds=None, stop="degree_one", p=0.5, k=1, seed=SEED)


@query("vertex_parts", f"""WITH {SALES}, ids AS (SELECT src AS id FROM sales UNION SELECT dst FROM sales)
SELECT ({rounds.hash60('part', 'id')} % 8)::INT AS part, count(*) AS vertices FROM ids GROUP BY 1""")
def _(spark, d):
    part = vertex_part("id", 8).alias("part")
    return vertices_of(sales_edges(spark, d)).groupBy(part).agg(F.count(F.lit(1)).alias("vertices"))


def _scored(links, seed, how):
    return f"""{how}, {rounds.prioritised(links, seed)}, {rounds.greedy('queue', 'g', 16)}
SELECT src, dst, score, round FROM g_chosen JOIN {links} USING (src, dst)"""


@query("scored_matching_endpoint", _scored("above", SEED, f"WITH {MEANS}, {ABOVE.format(links='scored_pairs')}"))
def _(spark, d):
    return matching.scored_matching(scored_pairs(spark, d), "endpoint_mean", method="greedy", seed=SEED)


@query("scored_matching_global", _scored("above", SEED, f"""WITH {SCORED_PAIRS}, good AS (
  SELECT * FROM scored_pairs WHERE score >= (SELECT avg(score) FROM scored_pairs)), means AS (
  SELECT id, avg(score) AS m FROM (
    SELECT src AS id, score FROM good UNION ALL SELECT dst, score FROM good) GROUP BY id),
{ABOVE.format(links='good')}"""))
def _(spark, d):
    return matching.scored_matching(scored_pairs(spark, d), "global_then_endpoint", method="greedy", seed=SEED)


@query("scored_matching_min", _scored("good", SEED, f"""WITH {SCORED_PAIRS}, good AS (
  SELECT * FROM scored_pairs WHERE score >= 40)"""))
def _(spark, d):
    return matching.scored_matching(scored_pairs(spark, d), ("min", 40), method="greedy", seed=SEED)


@query("scored_matching_mpc", f"""WITH {MEANS}, {ABOVE.format(links='scored_pairs')},
{rounds.mpc('above', SEED, 3, 8, 16)}
SELECT src, dst, score, round FROM matching JOIN above USING (src, dst)""")
def _(spark, d):
    return matching.scored_matching(scored_pairs(spark, d), "endpoint_mean", rounds=3, seed=SEED)


@query("scored_matching_all_degrees", f"""WITH {MEANS}, {ABOVE.format(links='scored_pairs')},
{rounds.mpc('above', SEED, 3, 8, 16, measured='scored_pairs')}
SELECT src, dst, score, round FROM matching JOIN above USING (src, dst)""")
def _(spark, d):
    return matching.scored_matching(scored_pairs(spark, d), "endpoint_mean", degrees_of="all", rounds=3, seed=SEED)
