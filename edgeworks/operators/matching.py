"""Maximal matchings: no vertex in two chosen edges, no edge left to choose.

Edges have a fixed random order: a hash of the edge, then its ends. Greedy
matching in that order is computed in rounds. In a round every vertex names
its first edge, and the edges named by both their ends are chosen. This gives
exactly the sequential greedy matching, in few rounds. Edges are laid out once at
both of their ends; a round shuffles what vertices say about them and no edge.
"""

from __future__ import annotations

import functools
import math
from contextlib import nullcontext

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.functions import hash60, uniform_below, vertex_part
from edgeworks.loop import Workspace, kept_wide, sized_shuffles, wide_shuffles
from edgeworks.operators import mates
from edgeworks.operators.graph import canonical_edges, degrees, endpoints, hot_vertices, max_degree, vertices_of
from edgeworks.operators.skew import fan_out, hot_keys, slot_keys, spread_join, with_slot

# Fixed values of the method: exponents of the largest degree for the sample
# probability and the number of vertex parts, base of the round limit.
SAMPLE_EXPONENT = -0.77
PARTS_EXPONENT = 0.12
ROUND_BASE = 1.1

#: Edges that are drawn at once, as a share of all, and the most rounds that it is drawn for.
DRAWN, MOST_DRAWN = 1.0, 128
#: Rounds that are drawn first, to see what they leave.
FIRST_DRAWN = 2
#: Samples of this share of the edges leave little, so rounds are drawn one by one, each from what the last has left.
LARGE_SAMPLE = 0.25
#: Edges are laid out anew when fewer than one in so many of their vertices goes on.
SPARSE = 4

ROUND_LIMITS = ("log_delta", "log_edges", "log_edges_p")
STOPS = ("empty", "unchanged", "degree_one")


def matching_params(edges: DataFrame, k_rounding: str = "floor") -> DataFrame:
    """``delta, p, k, max_rounds`` in one row, from the largest degree."""
    delta = F.col("delta")
    power = F.pow(delta, F.lit(PARTS_EXPONENT))
    k = F.ceil(power) if k_rounding == "ceil" else F.floor(power)
    return degrees(edges).agg(F.max("degree").alias("delta")).select(
        "delta",
        F.pow(delta, F.lit(SAMPLE_EXPONENT)).alias("p"),
        F.greatest(k, F.lit(1)).cast("bigint").alias("k"),
        F.ceil(F.log(delta) / F.lit(math.log(ROUND_BASE))).cast("bigint").alias("max_rounds"),
    )


def with_priority(edges: DataFrame, seed: int | None = 0) -> DataFrame:
    """Edges with their place ``priority`` in the random order."""
    return edges.withColumn("priority", hash60(seed, "src", "dst"))


def mutual_edges(edges: DataFrame) -> DataFrame:
    """Edges that come first at both their ends.

    ``edges`` has canonical ``src, dst, priority``. Each vertex names one
    edge, so the result never shares a vertex, equal priorities included.
    The edges are read twice, once to count them, and the result is written,
    over as many partitions as they need: a task sorts about a million ends.
    """
    ends = edges.select(
        F.inline(F.array(
            F.struct(F.col("src").alias("id"), F.struct("priority", F.col("dst").alias("other")).alias("first")),
            F.struct(F.col("dst").alias("id"), F.struct("priority", F.col("src").alias("other")).alias("first")),
        )))
    named = ends.groupBy("id").agg(F.min("first").alias("first"))
    pairs = named.select(
        F.least("id", "first.other").alias("src"), F.greatest("id", "first.other").alias("dst"))
    mutual = pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("named")).filter("named = 2").drop("named")
    return kept_wide(mutual, 2 * edges.count(), "mutual")


def matched_vertices(matching: DataFrame) -> DataFrame:
    """Distinct ends of the chosen edges, as ``id``."""
    return vertices_of(matching)


def residual_edges(edges: DataFrame, matched: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Edges with no end among the matched vertices ``id``."""
    left = edges
    for side in ("src", "dst"):
        gone = matched.select(F.col("id").alias(side))
        left = spread_join(left, gone, side, hot, by=["src", "dst"], how="left_anti")
    return left.select(*edges.columns)


def unmatched_edges(edges: DataFrame, matching: DataFrame, min_hot_rows: int | None = None) -> DataFrame:
    """Edges that are not in the matching, copies kept; those of a common pair are divided."""
    pair, n = F.struct("src", "dst").alias("pair"), edges.count()
    with wide_shuffles(edges.sparkSession, n):
        hot = hot_keys(edges.select(pair), "pair", min_rows=min_hot_rows)
    if hot is None:
        # By the columns themselves, so that no edge travels with a second copy of its ends.
        chosen = matching.select(F.col("src").alias("a"), F.col("dst").alias("b"))
        left = edges.join(chosen, F.col("src").eqNullSafe(F.col("a")) & F.col("dst").eqNullSafe(F.col("b")), "left_anti")
    else:
        left = spread_join(edges.select("*", pair), matching.select(pair).distinct(), "pair", hot, by=None, how="left_anti")
    return kept_wide(left.select(*edges.columns), n, "unmatched")


def sample_edges(edges: DataFrame, p: float, seed: int | None = 0, round: int = 0) -> DataFrame:
    """A Bernoulli sample, the same for the same seed and round."""
    return edges.filter(_sampled(p, seed, round))


def _sampled(p: float, seed: int | None, round: int) -> Column:
    return uniform_below(p, f"edge-{seed}-{round}", "src", "dst")


def same_part(edges: DataFrame, k: int, seed: int | str = 0) -> DataFrame:
    """Edges with both ends in one of ``k`` vertex parts."""
    return edges.filter(_in_one_part(k, seed))


def _in_one_part(k: int, seed: int | str) -> Column:
    if k <= 1:
        return F.lit(True)
    parts = [vertex_part(side, k, f"part-{seed}") for side in ("src", "dst")]
    return parts[0] == parts[1]


class _Layout:
    """Edges laid out once, at both of their ends, for rounds that move only what vertices say.

    Every edge stands at each end as ``id, other, priority``, shuffled and sorted
    by ``id`` (a hot vertex in slots) and kept in memory and on disk. In a round
    the vertices that still take part meet their edges where these lie; what is
    shuffled is the first edge of each neighbour, already the least of its task,
    and the pairs that name each other.
    """

    def __init__(self, halves: DataFrame, parts: int, hot: DataFrame | None):
        self.parts, self.hot = parts, hot
        self.keys = slot_keys("id", hot)
        laid = with_slot(halves.select("id", "other", "priority"), "id", hot, by=["other"])
        self.table = laid.repartition(parts, *self.keys).sortWithinPartitions(*self.keys).persist(StorageLevel.MEMORY_AND_DISK)

    @staticmethod
    def of(edges: DataFrame, parts: int, hot: DataFrame | None) -> _Layout:
        end = [F.struct(F.col(x).alias("id"), F.col(y).alias("other"), "priority") for x, y in (("src", "dst"), ("dst", "src"))]
        return _Layout(edges.select(F.inline(F.array(*end))), parts, hot)

    def at(self, vertices: DataFrame) -> DataFrame:
        """The edges at some vertices, from both of them where both are given."""
        return self.table.join(fan_out(vertices, "id", self.hot), self.keys)

    def decided(self, live: DataFrame | None) -> DataFrame:
        """``src, dst, id, chosen``: pairs that name each other are chosen; of
        others ``id`` is the vertex that named the edge and goes on.

        Only vertices in ``live`` take part, all of them without it.
        """
        if live is None:
            # Both ends of every edge take part, so a vertex finds its first edge where its edges lie.
            named = self.table.groupBy("id").agg(F.min(F.struct("priority", F.col("other").alias("mate"))).alias("first"))
        else:
            first = F.min(F.struct("priority", F.col("id").alias("mate"))).alias("first")
            named = self.at(live).groupBy(F.col("other").alias("id")).agg(first).join(live, "id")
        pair = [f("id", "first.mate").alias(name) for f, name in ((F.least, "src"), (F.greatest, "dst"))]
        met = named.select(*pair, "id").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
        return met.select("src", "dst", "id", (F.col("n") == 2).alias("chosen"))

    def among(self, live: DataFrame) -> _Layout:
        """The edges between live vertices, laid out anew: one shuffle."""
        back = self.at(live).select(F.col("other").alias("id"), F.col("id").alias("other"), "priority")
        smaller = _Layout(back.join(live, "id", "left_semi"), self.parts, self.hot)
        smaller.table.count()
        self.table.unpersist()
        return smaller

    def degrees(self) -> DataFrame:
        """``id, degree``; the edges of a vertex lie together, so only those of hot ones are put together."""
        return self.table.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


class _Job:
    """The tables and the chosen edges of one matching."""

    def __init__(self, spark):
        self.work = Workspace(spark)
        self.hot: DataFrame | None = None
        self.parts = 1
        self.chosen: list[DataFrame] = []

    def greedy(self, left: DataFrame, label: int | None = None, n_left: int = 0) -> list[DataFrame]:
        """Match the edges of ``left`` until none is left; many of them, ``n_left`` about, in a grid.

        ``label`` is the round number of the choices; without it each greedy
        round has its own. A round is one job, which writes the chosen edges and
        the vertices that go on side by side. When few go on, the edges between
        them are laid out anew, so that rounds do not walk over dead edges.
        """
        if mates.pays(left, n_left):
            found = mates.greedy_rounds(self.work, left, n_left, label)
            new = [] if found is None else [found]
            self.chosen += new
            return new
        # A sample has far fewer edges than the partitions of the whole are meant for.
        with sized_shuffles(self.work.spark, n_left) if n_left else nullcontext(self.parts) as parts:
            new = self._by_layout(left, label, parts)
        self.chosen += new
        return new

    def _by_layout(self, left: DataFrame, label: int | None, parts: int) -> list[DataFrame]:
        new, done, live, rest, laid = [], 0, None, None, None
        layout = _Layout.of(left, parts, self.hot)
        try:
            while True:
                done += 1
                number = F.lit(done if label is None else label)
                before = rest
                chosen, rest, going = self.work.keep_split(layout.decided(live), "chosen", "greedy")
                self.work.drop(before)
                if chosen is None:
                    break
                new.append(chosen.select("src", "dst", number.alias("round")))
                if rest is None:
                    break
                live = rest.select("id")
                if laid is None:
                    laid = going
                elif going * SPARSE < laid:
                    layout, laid = layout.among(live), going
        finally:
            layout.table.unpersist()
        return new

    def draw(self, left: DataFrame, rounds: range, p: float, k: int, seed) -> dict[int, DataFrame]:
        """The samples of several rounds by round, from one scan of the edges.

        Whether an edge is sampled in a round, and in which parts its ends are
        then, depends on the edge alone.
        """
        taken = F.array_compact(F.array(*[
            F.when(_sampled(p, seed, r) & _in_one_part(k, f"{seed}-{r}"), F.lit(r)) for r in rounds]))
        rows = left.select("*", F.explode(taken).alias("draw"))
        spread = F.pmod(F.xxhash64("src", "dst"), F.lit(1 + int(self.parts * min(p, 1) / k)))
        return self.work.keep_parts(rows.repartition(self.parts, "draw", spread) if len(rounds) > 1 else rows, "draw", rounds)

    def sampled(self, left: DataFrame, n_left: int, p: float, k: int, seed, done: int, last: float, stop: str):
        """Sampled rounds; what they leave, its size and the last round.

        A draw hashes every edge it scans once for each of its rounds, so it starts
        with ``FIRST_DRAWN`` rounds. Where their choices leave few edges, these are
        written as the table that the next draw scans, for twice as many rounds.
        Otherwise samples are drawn for as many rounds at once as take ``DRAWN`` of the
        edges, and the rest is written after them. In between only samples are read, so all
        rounds together scan about three times the edges at most.
        """
        large = p >= LARGE_SAMPLE
        degree = _Degrees(self, left) if stop == "degree_one" and not large else None
        over, looked, bound, read, few = False, 5 * n_left // 2, 3 * n_left, 0, FIRST_DRAWN
        found, written = [], 0
        while n_left and done < last and not over:
            most = 1 if large else max(1, min(MOST_DRAWN, int(DRAWN / p))) if p > 0 else MOST_DRAWN
            trial, lives = few < most and read + 3 * n_left <= bound, 1.0
            numbers = range(done + 1, int(min(done + (few if trial else most), last)) + 1)
            drawn, read = self.draw(left, numbers, p, k, seed), read + n_left
            for done in numbers:
                new = []
                if done in drawn:
                    sample = residual_edges(drawn[done], self.matched(found), self.hot) if found else drawn[done]
                    if trial and found and done == numbers[-1]:
                        # The share of a fresh sample that has no matched end is that of all edges.
                        lives = sample.count() / drawn[done].count()
                    new = self.greedy(sample, done, int(n_left * min(p, 1) / k))
                    found += new
                # Nothing sampled may mean that nothing is left. It is looked up while that is cheap.
                if not new and stop == "empty" and len(found) > written and read + n_left <= looked:
                    read += n_left
                    left, n_left = self.rest(left, found)
                    written = len(found)
                # A choice takes at least its own edge away.
                over = not new and (stop == "unchanged" or stop == "empty" and not n_left)
                if degree is not None:
                    if new:
                        degree.take(self.matched(new))
                    over = degree.largest <= 1
                if over:
                    break
            pays = not trial or done >= last or over or read + (1 + 2 * lives) * n_left <= bound
            if len(found) > written and pays:
                read += n_left
                left, n_left = self.rest(left, found)
                written = len(found)
            if len(found) == written:
                found, written = [], 0
            few = 2 * few if pays else most
            if large and stop == "degree_one":
                over = not n_left or max_degree(left).first()["delta"] <= 1
            for sample in drawn.values():
                self.work.drop(sample)
        if degree is not None:
            degree.layout.table.unpersist()
        return left, n_left, done

    def matched(self, found: list[DataFrame]) -> DataFrame:
        return endpoints(_union(found)).select("id")

    def rest(self, left: DataFrame, found: list[DataFrame]) -> tuple[DataFrame, int]:
        """The edges that touch none of the choices, written in place of ``left``, and their number."""
        kept, seen = self.work.keep(residual_edges(left, self.matched(found), self.hot), "left")
        self.work.drop(left)
        return kept, seen.get("rows") or 0


class _Degrees:
    """Degrees of the vertices that are free, from which every round takes off the edges that went."""

    def __init__(self, job: _Job, edges: DataFrame):
        self.job, self.layout = job, _Layout.of(edges, job.parts, job.hot)
        self._keep(self.layout.degrees())
        self.laid = self.vertices

    def _keep(self, rows: DataFrame) -> None:
        self.table, seen = self.job.work.keep(rows, "degrees", largest=F.max("degree"))
        self.largest, self.vertices = seen.get("largest") or 0, seen.get("rows") or 0

    def take(self, matched: DataFrame) -> None:
        """Newly matched vertices go, and each edge to a free vertex with them."""
        lost = self.layout.at(matched).groupBy(F.col("other").alias("id")).agg(F.count(F.lit(1)).alias("lost"))
        free = self.table.join(matched, "id", "left_anti").join(lost, "id", "left")
        left = free.select("id", (F.col("degree") - F.coalesce("lost", F.lit(0))).alias("degree"))
        before = self.table
        self._keep(left.filter("degree > 0"))
        self.job.work.drop(before)
        if self.vertices * SPARSE < self.laid:
            self.layout, self.laid = self.layout.among(self.table.select("id")), self.vertices


def greedy_matching(edges: DataFrame, seed: int | None = 0, min_hot_rows: int | None = None) -> DataFrame:
    """``src, dst, round``: the greedy matching in the seeded random order."""
    return maximal_matching(edges, method="greedy", seed=seed, min_hot_rows=min_hot_rows)


def mpc_round(edges: DataFrame, p: float, k: int, round: int = 1, seed: int | None = 0) -> DataFrame:
    """``src, dst, round``: greedy matching of a sample of the edges whose
    ends share a vertex part."""
    return maximal_matching(edges, p=p, k=k, rounds=1, first_round=round, seed=seed, sweep=False)


def maximal_matching(
    edges: DataFrame,
    method: str = "mpc",
    p: float | None = None,
    k: int | None = None,
    rounds: int | str | None = "log_delta",
    stop: str = "empty",
    seed: int | None = 0,
    k_rounding: str = "floor",
    first_round: int = 1,
    sweep: bool = True,
    min_hot_rows: int | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """``src, dst, round``: a maximal matching of the undirected edges.

    ``method="greedy"`` runs greedy rounds until no edge is left. ``"mpc"``
    samples edges with probability ``p``, keeps those with both ends in one of
    ``k`` vertex parts, drawn anew each round, matches them, removes the edges they touch, and
    repeats; ``p`` and ``k`` follow from the largest degree when not given.
    ``rounds`` is a number, a limit by name, or None for no limit; ``stop``
    ends the rounds early when no edge is left, when a round removed none, or
    when no vertex has more than one edge. What is left is then matched
    greedily, so the result is maximal whatever the sampling did. The largest
    degree is that of ``measured`` edges where they are given.

    Self-loops and copies of an edge do not matter.
    """
    if method not in ("greedy", "mpc"):
        raise ValueError(f"method must be greedy or mpc, not {method!r}")
    if stop not in STOPS:
        raise ValueError(f"stop must be one of {STOPS}, not {stop!r}")
    job = _Job(edges.sparkSession)
    left, seen = job.work.keep(with_priority(canonical_edges(edges), seed), "edges")
    n_left = seen.get("rows")
    if not n_left:
        return left.select("src", "dst", F.lit(0).alias("round"))
    job.hot = hot_vertices(left, min_rows=min_hot_rows)
    with sized_shuffles(edges.sparkSession, n_left) as job.parts:
        if method == "greedy":
            job.greedy(left, n_left=n_left)
        else:
            row = None
            if p is None or k is None or rounds == "log_delta":
                row = matching_params(edges if measured is None else measured, k_rounding).first()
            p = row["p"] if p is None else p
            k = row["k"] if k is None else k
            if rounds is None and p <= 0:
                raise ValueError("without a round limit p must be above 0")
            limit = _round_limit(rounds, row, n_left, p)
            done = first_round - 1
            left, n_left, done = job.sampled(left, n_left, p, k, seed, done, done + limit, stop)
            if sweep and n_left:
                job.greedy(left, done + 1, n_left)
    if not job.chosen:
        return left.limit(0).select("src", "dst", F.lit(0).alias("round"))
    return _union(job.chosen)


def _union(tables: list[DataFrame]) -> DataFrame:
    """The choices of several rounds; they are disjoint already."""
    return functools.reduce(DataFrame.unionAll, tables)


def _round_limit(rounds: int | str | None, params, n_edges: int, p: float) -> float:
    if rounds is None:
        return math.inf
    if isinstance(rounds, int):
        return rounds
    if rounds == "log_delta":
        return max(1, params["max_rounds"])
    if rounds == "log_edges":
        return max(1, math.ceil(math.log(n_edges)))
    if rounds == "log_edges_p":
        return max(1, math.ceil(math.log(n_edges) / math.log(1 / p))) if p < 1 else 1
    raise ValueError(f"rounds must be a number, None or one of {ROUND_LIMITS}, not {rounds!r}")


def validate_matching(matching: DataFrame) -> DataFrame:
    """``id, count`` of the vertices in more than one chosen edge."""
    return endpoints(matching).groupBy("id").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def validate_maximal(matching: DataFrame, edges: DataFrame, min_hot_rows: int | None = None) -> DataFrame:
    """``src, dst`` of the edges that could still be added."""
    n = edges.count()
    candidates = kept_wide(canonical_edges(edges), n, "candidates")
    with wide_shuffles(edges.sparkSession, 2 * n):
        hot = hot_vertices(candidates, min_rows=min_hot_rows)
    return kept_wide(residual_edges(candidates, matched_vertices(matching), hot), n, "addable")


def matching_size(matching: DataFrame) -> DataFrame:
    """Number of chosen edges as ``edges``."""
    return matching.agg(F.count(F.lit(1)).alias("edges"))


def scored_matching(
    links: DataFrame, rule: str | tuple[str, float] = "endpoint_mean", degrees_of: str = "chosen", **options
) -> DataFrame:
    """``src, dst, score, round``: a maximal matching of well scored links.

    ``rule`` says which links take part: ``"endpoint_mean"``, score above the
    mean of both ends over all links; ``"global_then_endpoint"``, first those
    at or above the mean of all links, then as before among these; ``("min",
    t)``, score at least t. A pair linked more than once has its best score.
    ``degrees_of`` says whose largest degree the sampling follows: that of the
    links that take part (``"chosen"``), or of ``"all"``.
    """
    if degrees_of not in ("chosen", "all"):
        raise ValueError(f"degrees_of must be chosen or all, not {degrees_of!r}")
    from edgeworks.operators.scores import (
        filter_above_endpoint_means,
        filter_above_mean,
        filter_score,
    )

    if rule == "endpoint_mean":
        good = filter_above_endpoint_means(links)
    elif rule == "global_then_endpoint":
        good = filter_above_endpoint_means(filter_above_mean(links))
    elif isinstance(rule, tuple) and rule[0] == "min":
        good = filter_score(links, rule[1])
    else:
        raise ValueError(f"unknown rule {rule!r}")
    pairs = good.filter("src != dst").groupBy(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max("score").alias("score"))
    pairs, _ = Workspace(links.sparkSession).keep(pairs, "pairs")
    measured = links if degrees_of == "all" else None
    return pairs.join(maximal_matching(pairs, measured=measured, **options), ["src", "dst"])
