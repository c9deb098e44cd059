import pytest
from data import edges, random_rows, table

from edgeworks.operators import skew


def test_no_hot_key_below_the_limit(spark):
    assert skew.hot_keys(edges(spark, random_rows(0)), "src", min_rows=10_000) is None
    assert skew.hot_keys(edges(spark, []), "src") is None


def test_slots_have_a_fixed_size_however_large_the_table(spark):
    for others in (500, 5000):
        hot = skew.hot_keys(edges(spark, [(0, i) for i in range(500)] + [(i, i) for i in range(1, others)]), "src", min_rows=50)
        assert table(hot) == [(0, 10)]


def test_copies_of_one_pair_are_divided(spark):
    rows = edges(spark, [(0, 1)] * 1000 + [(i, i) for i in range(1, 50)])
    hot = skew.hot_keys(rows, "src", min_rows=100)
    slots = skew.with_slot(rows, "src", hot, None).filter("src = 0").groupBy("slot").count().collect()
    assert len(slots) == 10 and max(r["count"] for r in slots) <= 200


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    rows = edges(spark, random_rows(2))
    lookup = spark.createDataFrame([(i, float(i)) for i in range(0, 30, 2)], "src bigint, v double")
    hot = skew.hot_keys(rows, "src", min_rows=5)
    assert hot is not None
    spread = skew.spread_join(rows, lookup, "src", hot, ["dst"], how)
    plain = rows.join(lookup, "src", how)
    assert sorted(map(repr, spread.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_hot_rows_go_to_several_tasks(spark):
    rows = edges(spark, [(0, i) for i in range(400)])
    hot = skew.hot_keys(rows, "src", min_rows=50)
    slots = skew.with_slot(rows, "src", hot, ["dst"]).groupBy("slot").count().collect()
    assert len(slots) == 8 and max(r["count"] for r in slots) < 100
