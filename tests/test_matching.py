"""Matchings are checked against the sequential greedy one and by definition."""

import hashlib

import pytest
from data import PARTS, edges, links, random_rows, table, undirected
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from edgeworks.operators import grid, matching, mates
from edgeworks.operators.matching import (
    maximal_matching,
    scored_matching,
    validate_matching,
    validate_maximal,
)


def greedy_by_hand(rows, seed):
    def place(edge):
        text = f"{seed}|{edge[0]}|{edge[1]}"
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16), edge

    taken, chosen = set(), []
    for a, b in sorted(undirected(rows), key=place):
        if a not in taken and b not in taken:
            chosen.append((a, b))
            taken |= {a, b}
    return sorted(chosen)


def pairs(df):
    return table(df.select("src", "dst"))


def check(found, rows, e):
    chosen = pairs(found)
    assert set(chosen) <= set(undirected(rows))
    assert table(validate_matching(found)) == []
    assert table(validate_maximal(found, e)) == []


@pytest.mark.parametrize("hot", [None, 4], ids=["plain", "divided"])
@pytest.mark.parametrize("seed", [0, 1])
def test_greedy_is_the_sequential_one(spark, hot, seed):
    rows = random_rows(seed)
    found = maximal_matching(edges(spark, rows), method="greedy", seed=seed, min_hot_rows=hot)
    assert pairs(found) == greedy_by_hand(rows, seed)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8)), max_size=20), seed=st.integers(0, 3))
def test_greedy_on_any_graph(spark, rows, seed):
    found = maximal_matching(edges(spark, rows), method="greedy", seed=seed)
    assert pairs(found) == greedy_by_hand(rows, seed)


def test_equal_priorities_never_share_a_vertex(spark):
    rows = undirected(random_rows(3))
    tied = spark.createDataFrame([(a, b, 7) for a, b in rows], "src bigint, dst bigint, priority bigint")
    assert table(validate_matching(matching.mutual_edges(tied))) == []
    assert pairs(matching.mutual_edges(tied))[0] == rows[0]


@pytest.mark.parametrize("options", [
    {"rounds": 2, "p": 0.5, "k": 3, "stop": "degree_one"},
    {"rounds": None, "p": 0.9, "stop": "degree_one"},
    {"rounds": "log_edges", "p": 0.6, "stop": "unchanged"},
    {"rounds": "log_edges_p", "p": 0.5},
    {"rounds": 1, "p": 0.0},
    {"rounds": 2, "p": 1.0, "k_rounding": "ceil"},
], ids=str)
def test_sampled_matching_is_maximal(spark, options):
    rows = random_rows(7)
    e = edges(spark, rows)
    found = maximal_matching(e, seed=5, **options)
    check(found, rows, e)


def test_sampled_matching_does_not_depend_on_partitions(spark):
    e = edges(spark, random_rows(8))
    assert pairs(maximal_matching(e, rounds=2, p=0.5)) == pairs(maximal_matching(e.repartition(5), rounds=2, p=0.5))


def test_matching_without_edges(spark):
    assert pairs(maximal_matching(edges(spark, []))) == []
    assert pairs(maximal_matching(edges(spark, [(1, 1)]), method="greedy")) == []
    assert pairs(matching.mpc_round(edges(spark, [(1, 2)]), p=0.0, k=1)) == []


def test_unknown_settings_are_refused(spark):
    e = edges(spark, [(1, 2)])
    for wrong in ({"method": "best"}, {"stop": "never"}, {"rounds": "many"}):
        with pytest.raises(ValueError):
            maximal_matching(e, **wrong)
    with pytest.raises(ValueError):
        scored_matching(links(spark, [("a", "b", 1.0)]), "best")


def test_parameters(spark):
    star = edges(spark, [(0, i) for i in range(1, 37)])
    row = matching.matching_params(star).first()
    assert (row["delta"], row["k"], row["max_rounds"]) == (36, 1, 38)
    assert row["p"] == pytest.approx(0.063335, abs=1e-6)
    assert matching.matching_params(star, "ceil").first()["k"] == 2


def test_validators_find_what_is_wrong(spark):
    e = edges(spark, [(1, 2), (2, 3), (4, 5)])
    assert table(validate_matching(e)) == [(2, 2)]
    assert table(validate_maximal(edges(spark, [(1, 2)]), e)) == [(4, 5)]


def test_residual_looks_at_both_ends(spark):
    e = edges(spark, [(1, 2), (3, 1), (3, 4), (3, 4)])
    matched = spark.createDataFrame([(1,)], "id bigint")
    assert table(matching.residual_edges(e, matched)) == [(3, 4), (3, 4)]
    assert table(matching.unmatched_edges(e, edges(spark, [(3, 4)]))) == [(1, 2), (3, 1)]


@pytest.mark.parametrize("rule", ["endpoint_mean", "global_then_endpoint", ("min", 5.0)], ids=str)
def test_scored_matching(spark, rule):
    rows = [(f"a{i % 7}", f"b{i % 5}", float(i * 7 % 11)) for i in range(35)]
    all_links = links(spark, rows)

    def means(some):
        at = {}
        for a, b, s in some:
            at.setdefault(a, []).append(s)
            at.setdefault(b, []).append(s)
        return {v: sum(x) / len(x) for v, x in at.items()}

    good = rows
    if isinstance(rule, tuple):
        good = [r for r in rows if r[2] >= rule[1]]
    else:
        if rule == "global_then_endpoint":
            overall = sum(r[2] for r in rows) / len(rows)
            good = [r for r in rows if r[2] >= overall]
        m = means(good)
        good = [r for r in good if r[2] > max(m[r[0]], m[r[1]])]
    found = scored_matching(all_links, rule, method="greedy", seed=2)
    assert pairs(found) == greedy_by_hand([r[:2] for r in good], 2)
    best = {r[:2]: r[2] for r in good}
    assert all(r["score"] == best[r["src"], r["dst"]] for r in found.collect())


def laid_out(spark, rows, hot=None):
    e = matching.with_priority(spark.createDataFrame(undirected(rows), "src bigint, dst bigint"), 0)
    layout = matching._Layout.of(e, PARTS, matching.hot_vertices(e, min_rows=hot) if hot else None)
    layout.table.count()
    return layout


def test_a_greedy_round_shuffles_no_edge(spark):
    """Edges lie in the layout; only vertices, their first edges and named pairs move."""
    layout = laid_out(spark, random_rows(31))
    live = spark.range(0, 25).repartition(PARTS, "id").persist()
    live.count()
    found = layout.decided(live)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert 1 <= len(moved) <= 3
    for line in moved:
        # By the vertex that is told (after partial least), by the vertices themselves, by the pair.
        assert any(f"hashpartitioning({key}" in line for key in ("id#", "other#", "src#", "_groupingexpression#")), line
    assert "min(struct(priority" in plan
    live.unpersist()
    layout.table.unpersist()


def test_the_first_round_tells_no_neighbour(spark):
    """All edges take part, so the first of each vertex is found where its edges lie; only the pairs move."""
    layout = laid_out(spark, random_rows(36))
    found = layout.decided(None)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    layout.table.unpersist()


@pytest.mark.parametrize("hot", [None, 4], ids=["plain", "divided"])
def test_laid_out_anew_the_live_edges_remain(spark, hot):
    rows = random_rows(32)
    keep = set(range(0, 30, 2)) | {1, 3}
    live = spark.createDataFrame([(v,) for v in keep], "id bigint")
    smaller = laid_out(spark, rows, hot).among(live)
    want = [(a, b) for a, b in undirected(rows) if a in keep and b in keep]
    assert table(smaller.table.select("id", "other")) == sorted(want + [(b, a) for a, b in want])
    smaller.table.unpersist()


@pytest.mark.parametrize("hot", [None, 4], ids=["plain", "divided"])
def test_degrees_are_taken_off(spark, hot):
    from collections import Counter

    rows = undirected(random_rows(33))
    e = matching.with_priority(spark.createDataFrame(rows, "src bigint, dst bigint"), 0)
    job = matching._Job(spark)
    job.parts, job.hot = PARTS, matching.hot_vertices(e, min_rows=hot) if hot else None
    degree, gone = matching._Degrees(job, e), set()
    for newly in ({0, 5}, {3}, set(range(6, 25))):
        gone |= newly
        degree.take(spark.createDataFrame([(v,) for v in newly], "id bigint"))
        want = Counter(v for a, b in rows if a not in gone and b not in gone for v in (a, b))
        assert dict(table(degree.table)) == want and degree.largest == max(want.values(), default=0)
    degree.layout.table.unpersist()


def test_sampled_rounds_scan_few_edges(spark, monkeypatch):
    """All draws and all residuals of a matching read at most three times the edges."""
    rows = random_rows(34, vertices=60, count=300)
    read = []
    draw, rest = matching._Job.draw, matching._Job.rest
    monkeypatch.setattr(matching._Job, "draw", lambda self, left, *a: (read.append(left.count()), draw(self, left, *a))[1])
    monkeypatch.setattr(matching._Job, "rest", lambda self, left, found: (read.append(left.count()), rest(self, left, found))[1])
    e = edges(spark, rows)
    check(maximal_matching(e, seed=1, rounds=14), rows, e)
    assert len(read) >= 2 and sum(read) <= 3 * len(undirected(rows))


def test_samples_of_many_rounds_are_those_of_each(spark):
    e = matching.with_priority(spark.createDataFrame(undirected(random_rows(35)), "src bigint, dst bigint"), 0)
    job = matching._Job(spark)
    drawn = job.draw(e, range(3, 9), 0.2, 2, 7)
    for number in range(3, 9):
        want = table(matching.same_part(matching.sample_edges(e, 0.2, 7, number), 2, f"7-{number}"))
        assert (table(drawn[number].select(*e.columns)) if number in drawn else []) == want


def test_degree_over_all_links(spark):
    rows = [(f"a{k % 9}", f"b{k}", float(k % 7)) for k in range(60)]
    both = [table(scored_matching(links(spark, rows), ("min", 6.0), degrees_of=x, rounds=1, sweep=False)) for x in ("chosen", "all")]
    assert both[0] != both[1]
    with pytest.raises(ValueError):
        scored_matching(links(spark, rows), degrees_of="some")


def test_one_round_of_choices_uses_as_many_partitions_as_the_edges_need(spark, monkeypatch):
    """With a fixed number of partitions a task's sorts and hash tables grew with the edges."""
    from edgeworks import loop
    from edgeworks.operators.matching import mutual_edges, unmatched_edges, validate_maximal, with_priority

    usual, widths = spark.conf.get(loop.SHUFFLE_PARTS), []
    write = loop.Workspace._write
    monkeypatch.setattr(loop, "ROWS_PER_PART", 20)
    monkeypatch.setattr(loop.Workspace, "_write", lambda work, *args, **kw: (
        widths.append(int(work.spark.conf.get(loop.SHUFFLE_PARTS))), write(work, *args, **kw))[1])
    pairs = undirected(random_rows(41, vertices=60, count=300))
    queue = with_priority(edges(spark, pairs), 0)
    chosen = mutual_edges(queue)
    left = validate_maximal(chosen, queue)
    other = unmatched_edges(queue, chosen)
    assert widths and min(widths) >= len(pairs) // 20
    assert spark.conf.get(loop.SHUFFLE_PARTS) == usual
    ends = {x for pair in table(chosen) for x in pair}
    assert table(chosen) and len(ends) == 2 * chosen.count()
    assert table(left) == [(a, b) for a, b in pairs if a not in ends and b not in ends]
    assert table(other.select("src", "dst")) == sorted(set(pairs) - set(table(chosen)))


@pytest.mark.parametrize("kind", ["bigint", "int"])
@pytest.mark.parametrize("options", [
    {"method": "greedy"},
    {"rounds": None, "stop": "unchanged", "p": 0.5, "k": 1},
    {"rounds": None, "stop": "degree_one", "p": 0.5, "k": 1},
    {"rounds": "log_edges_p", "k_rounding": "ceil"},
], ids=["greedy", "unchanged", "degree_one", "log_edges_p"])
def test_greedy_rounds_in_a_grid_lay_no_edges_out(spark, monkeypatch, kind, options):
    rows = random_rows(5, vertices=60, count=300) + [(None, 3), (4, None), (None, None)]
    e = edges(spark, rows, kind)
    want = maximal_matching(e, seed=2, **options)
    for module, name, value in ((grid, "SMALL_BLOCK", 40), (grid, "CHUNK", 16), (mates, "LEAST_EDGES", 0), (mates, "BLOCK_EDGES", 50), (matching, "_Layout", None)):
        monkeypatch.setattr(module, name, value)
    got = maximal_matching(e, seed=2, **options)
    assert got.schema["src"].dataType == want.schema["src"].dataType and got.dtypes == want.dtypes
    assert table(got) == table(want)
    if options == {"method": "greedy"}:
        assert pairs(got) == greedy_by_hand(rows[:-3], 2)


@pytest.mark.parametrize("stop", ["unchanged", "degree_one"])
def test_a_large_sample_is_drawn_from_what_is_left(spark, monkeypatch, stop):
    rows = random_rows(6, vertices=200, count=900)
    scanned, draw = [], matching._Job.draw

    def drawn(self, left, rounds, *rest):
        scanned.append((len(rounds), left.count()))
        return draw(self, left, rounds, *rest)

    monkeypatch.setattr(matching._Job, "draw", drawn)
    # Probability and parts are given, so no degree decides.
    monkeypatch.setattr(matching, "matching_params", None)
    found = maximal_matching(edges(spark, rows), rounds=None, stop=stop, p=0.5, k=1, seed=1)
    check(found, rows, edges(spark, rows))
    assert all(n == 1 for n, _ in scanned) and scanned[1][1] < scanned[0][1] / 2


def test_few_rounds_are_drawn_before_it_is_known_what_they_leave(spark, monkeypatch):
    """Every edge used to be hashed for the rounds to come, though the first ones leave next to nothing."""
    rows = [(a, 100 + b) for a in range(12) for b in range(60)]
    e, scanned, draw = edges(spark, rows), [], matching._Job.draw

    def drawn(self, left, rounds, *rest):
        scanned.append((len(rounds), left.count()))
        return draw(self, left, rounds, *rest)

    monkeypatch.setattr(matching._Job, "draw", drawn)
    found = table(maximal_matching(e, p=0.05, k=1, rounds=40, seed=3))
    assert sum(n * left for n, left in scanned) <= 4 * len(rows)
    monkeypatch.setattr(matching, "FIRST_DRAWN", 10**6)
    scanned.clear()
    assert table(maximal_matching(e, p=0.05, k=1, rounds=40, seed=3)) == found
    assert scanned[0] == (20, len(rows))


def test_a_sample_takes_the_partitions_of_its_own_edges(spark, monkeypatch):
    parts, of = [], matching._Layout.of
    monkeypatch.setattr(matching._Layout, "of", staticmethod(lambda edges, n, hot: (parts.append(n), of(edges, n, hot))[1]))
    job = matching._Job(spark)
    job.parts = 50
    e = matching.with_priority(edges(spark, undirected(random_rows(9))), 0)
    job.greedy(e, 1, 10)
    assert parts == [PARTS]


@pytest.mark.parametrize("hot", [None, 2], ids=["plain", "divided"])
def test_unmatched_edges_travel_once(spark, hot):
    """Nulls are ends like others, copies stay, and no edge is shuffled with a second copy of its ends."""
    e = edges(spark, [(1, 2), (1, 2), (1, 2), (None, 3), (None, 3), (4, None), (5, 6)])
    left = matching.unmatched_edges(e, edges(spark, [(None, 3), (5, 6)]), hot)
    assert sorted(map(str, map(tuple, left.collect()))) == ["(1, 2)"] * 3 + ["(4, None)"]


def test_unmatched_edges_are_not_copied_for_the_join(spark, monkeypatch):
    plans, kept = [], matching.kept_wide
    monkeypatch.setattr(matching, "kept_wide", lambda df, *a: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), kept(df, *a))[1])
    matching.unmatched_edges(edges(spark, [(1, 2), (3, 4)]), edges(spark, [(1, 2)]))
    assert "struct" not in plans[0] and "Aggregate" not in plans[0]


@pytest.mark.parametrize("p", [-1.0, 0.0, 1e-9, 0.0073, 0.5, 1 - 2**-53, 1.0, 1.5])
def test_hex_digits_tell_what_numbers_do(spark, p):
    from edgeworks.functions import uniform, uniform_below

    rows = spark.range(2000)
    assert rows.filter((uniform("x", "id") < p) != uniform_below(p, "x", "id")).count() == 0


def test_hex_digits_at_the_value_itself(spark):
    from edgeworks.functions import uniform, uniform_below

    for row in spark.range(5).select("id", uniform("x", "id").alias("u")).collect():
        one = spark.range(row["id"], row["id"] + 1)
        for p in (row["u"], row["u"] + 2**-53):
            assert one.filter(uniform_below(p, "x", "id")).count() == (row["u"] < p)
