from collections import Counter

import pytest
from data import links, table
from pyspark.sql import functions as F

from edgeworks.loop import Workspace, iterate, sized_shuffles
from edgeworks.operators import balance, scores, tables


def test_word_count_keeps_empty_words_and_case(spark):
    df = spark.createDataFrame([("a  b A",), ("a ",)], "value string")
    assert dict(table(tables.word_count(df))) == {"a": 2, "": 2, "b": 1, "A": 1}


def test_join_keeps_the_key_once(spark):
    people = spark.createDataFrame([(1, "Ann"), (2, "Bo"), (4, "Cy")], "id int, name string")
    places = spark.createDataFrame([(1, "here"), (2, "there"), (3, "nowhere")], "id int, place string")
    assert tables.join_on(people, places, "id").columns == ["id", "name", "place"]
    assert table(tables.join_on(people, places, "id")) == [(1, "Ann", "here"), (2, "Bo", "there")]


def test_top_k_is_not_a_full_sort(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    best = tables.top_k(df, "v", 3, "id")
    assert [tuple(r) for r in best.collect()] == [(6, 6), (13, 6), (20, 6)]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def test_row_index(spark):
    df = spark.range(0, 500, 1, 9).select((F.lit(1000) - F.col("id")).alias("v"))
    got = [(r["v"], r["row_index"]) for r in tables.with_row_index(df, "v").orderBy("v").collect()]
    assert got == [(501 + i, i) for i in range(500)]
    assert tables.with_row_index(df.limit(0), "v").collect() == []


def test_rows_per_partition(spark):
    assert table(tables.rows_per_partition(spark.range(0, 10, 1, 2))) == [(0, 5), (1, 5)]
    assert tables.is_empty(spark.range(0)) and not tables.is_empty(spark.range(1))


@pytest.mark.parametrize("hot", [None, 2])
def test_scores_by_hand(spark, hot):
    rows = [("a", "b", 4.0), ("a", "c", 2.0), ("b", "c", 9.0), ("a", "d", 5.0), ("a", "e", 1.0)]
    df = links(spark, rows)
    at = {}
    for a, b, s in rows:
        at.setdefault(a, []).append(s)
        at.setdefault(b, []).append(s)
    means = {v: sum(s) / len(s) for v, s in at.items()}
    assert dict(table(scores.vertex_mean_score(df))) == pytest.approx(means)
    assert table(scores.filter_above_endpoint_means(df, min_hot_rows=hot)) == sorted(
        r for r in rows if r[2] > max(means[r[0]], means[r[1]]))
    assert table(scores.filter_above_mean(df)) == sorted(r for r in rows if r[2] >= 4.2)
    assert table(scores.filter_score(df, 4)) == sorted(r for r in rows if r[2] >= 4)


def test_missing_means_count_as_zero(spark):
    df = links(spark, [("a", "b", 1.0), ("a", "c", 0.0)])
    means = spark.createDataFrame([("a", 0.5)], "id string, avg_score double")
    assert table(scores.filter_above_endpoint_means(df, means)) == [("a", "b", 1.0)]
    assert table(scores.mean_score(df.limit(0))) == [(0.0,)]


def test_loop_state_is_written_and_dropped(spark):
    work = Workspace(spark)
    start, seen = work.keep(spark.range(4), "start", top=F.max("id"))
    assert seen == {"rows": 4, "top": 3}
    rounds = []

    def step(df, done):
        rounds.append(done)
        return df.select((F.col("id") + 1).alias("id"))

    end, seen, done = iterate(
        work, start, step, None, stop=lambda seen: seen["top"] >= 7, cut_every=2, top=F.max("id"))
    assert (done, rounds) == (4, [1, 2, 3, 4]) and table(end) == [(4,), (5,), (6,), (7,)]
    with pytest.raises(Exception, match="(?i)not.*exist"):
        start.collect()
    work.drop(spark.range(1))  # not ours, so nothing happens


def test_small_loops_use_few_partitions_for_a_while(spark):
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    try:
        spark.conf.set(name, "1000")
        with sized_shuffles(spark, 10) as parts:
            assert parts == spark.sparkContext.defaultParallelism == int(spark.conf.get(name))
        assert spark.conf.get(name) == "1000"
        with sized_shuffles(spark, 10**12) as parts:
            assert parts == 1000
    finally:
        spark.conf.set(name, usual)
    assert Counter([spark.conf.get(name)]) == Counter([usual])


def test_rows_per_host(spark):
    df = spark.range(0, 1000, 1, 7)
    by_task = balance.rows_by_task(df)
    assert sorted(r["rows"] for r in by_task.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert balance.rows_by_task(df.filter("id < 0")).collect() == []
    found = balance.rows_per_host(df).collect()
    assert sum(r["rows"] for r in found) == 1000 and sum(r["tasks"] for r in found) == 7
