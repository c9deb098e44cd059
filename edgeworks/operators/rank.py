"""PageRank over directed edges.

Every vertex starts at 1. A vertex divides its rank over its out-edges,
parallel edges counting each time; what a sink holds goes nowhere. At the end
the ranks are scaled to sum to the number of vertices.

Graphs with many links a vertex go through a grid of packed links, where a round
moves arrays; sparse ones through routes, where it moves a row for each message.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import Workspace, iterate, wide_shuffles
from edgeworks.operators import grid
from edgeworks.operators.graph import Graph
from edgeworks.operators.routes import routes_over


def links_of(graph: Graph) -> DataFrame:
    """One row per linked pair with its number of ``copies``, so that repeated
    edges do not make a key hot."""
    return graph.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))


def pagerank(
    graph: Graph,
    reset: float = 0.15,
    max_iter: int = 10,
    tol: float | None = None,
    cut_every: int = 5,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """``id, pagerank`` after ``max_iter`` rounds, or to a tolerance.

    With ``tol``, vertices whose rank last grew by more than ``tol`` send that
    growth on, until there are none; ``max_iter`` is not used then.
    """
    spark = graph.edges.sparkSession
    work, links = Workspace(spark), links_of(graph)
    if graph.derived and _has_plain_ids(links):
        with wide_shuffles(spark, graph.edges.count()):
            links = links.persist(StorageLevel.MEMORY_AND_DISK)
            n_links = links.count()
            vertices, seen = work.keep(_senders(links, sums_come=tol is None and max_iter > 0), "vertices")
        parts = grid.parts_for(n_links, seen["rows"], spark.sparkContext.defaultParallelism)
        if grid.pays(n_links, seen["rows"], parts):
            return _in_grid(links, vertices, seen["rows"], parts, work, reset, max_iter, tol, cut_every)
        work.drop(vertices)
    with routes_over(links, graph, min_hot_rows) as routes:
        if tol is None:
            state, seen = _fixed(routes, work, reset, max_iter, cut_every)
        else:
            state, seen = _until(routes, work, reset, tol)
    factor = seen["rows"] / seen["total"] if seen.get("total") else 1.0
    return state.select("id", (F.col("rank") * F.lit(factor)).alias("pagerank"))


def _has_plain_ids(links: DataFrame) -> bool:
    kinds = {links.schema[x].dataType.simpleString() for x in ("src", "dst")}
    return len(kinds) == 1 and kinds <= {"int", "bigint", "string"}


def _senders(links: DataFrame, sums_come: bool) -> DataFrame:
    """``id`` and the ``out`` copies of its links.

    A null id sends nothing; where new ranks are sums, it has one only if a link
    leads to it.
    """
    told = F.col("src").isNotNull()
    ends = links.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.col("copies").alias("out"), F.lit(False).alias("told")),
        F.struct(F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("out"), told.alias("told")))))
    found = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("told").alias("told"))
    return (found.filter("id IS NOT NULL OR told") if sums_come else found).select("id", "out")


def _in_grid(links, vertices, n, parts, work, reset, max_iter, tol, cut_every):
    # What is not summed, growth, does not reach a null id.
    met = links.filter("src IS NOT NULL" if tol is None else "src IS NOT NULL AND dst IS NOT NULL")
    with grid.Grid(met, vertices, parts) as blocks:
        links.unpersist()
        seen = {"total": F.sum("total"), "sending": F.sum("sending")}
        if tol is None:
            state = blocks.start(1.0)
            if max_iter:
                state, seen, _ = iterate(work, state, lambda x, _: blocks.round(x, reset), max_iter, cut_every=cut_every, **seen)
            else:
                state, seen = work.keep(state, **seen)
        else:
            # Rounds after the last that sends change nothing, so it is enough to look now and then.
            state, seen, _ = iterate(
                work, blocks.start(float(reset), float(reset)), lambda x, _: blocks.round(x, reset, tol), None,
                stop=lambda seen: not seen.get("sending"), cut_every=cut_every, **seen)
        ranks, _ = work.keep(blocks.rows(state, "value" if tol is None else "held", "rank"), "ranks")
    work.clear(ranks)
    factor = n / seen["total"] if seen.get("total") else 1.0
    return ranks.select("id", (F.col("rank") * F.lit(factor)).alias("pagerank"))


def _kept(column: str):
    """What the own link says about the vertex itself."""
    return F.max(F.when(F.col("own"), F.col(column))).alias(column)


def _fixed(routes, work, reset, max_iter, cut_every):
    start = routes.vertices().select("id", "out", F.lit(1.0).alias("rank"))

    def step(state: DataFrame, _: int) -> DataFrame:
        # A sink has only its own link, and that has no copies to carry.
        share = F.when(F.col("out") > 0, F.col("copies") * (F.col("rank") / F.col("out"))).otherwise(F.lit(0.0))
        return routes.deliver(state).groupBy(F.col("dst").alias("id")).agg(
            _kept("out"), (F.lit(reset) + F.lit(1 - reset) * F.sum(share)).alias("rank"))

    total = F.sum("rank")
    if max_iter == 0:
        return work.keep(start, total=total)
    state, seen, _ = iterate(work, start, step, max_iter, cut_every=cut_every, total=total)
    return state, seen


def _until(routes, work, reset, tol):
    first = F.lit(float(reset))
    start = routes.vertices().select("id", "out", first.alias("rank"), first.alias("growth"))
    growing = F.col("growth") > F.lit(tol)

    def step(state: DataFrame, _: int) -> DataFrame:
        # Only vertices that still grow meet their links; the others' ranks wait in the state.
        sending = state.filter(growing & (F.col("out") > 0)).select("id", (F.col("growth") / F.col("out")).alias("unit"))
        sent = routes.deliver(sending).filter(~F.col("own")).groupBy("dst").agg(
            (F.lit(1 - reset) * F.sum(F.col("copies") * F.col("unit"))).alias("gained"))
        after = state.join(sent, F.col("id") == F.col("dst"), "left")
        gained = F.coalesce("gained", F.lit(0.0))
        return after.select("id", "out", (F.col("rank") + gained).alias("rank"), gained.alias("growth"))

    # A round uses its state twice, so each is written.
    state, seen, _ = iterate(
        work, start, step, None,
        stop=lambda seen: not seen.get("growing"),
        growing=F.sum(growing.cast("bigint")),
        total=F.sum("rank"),
    )
    return state, seen
