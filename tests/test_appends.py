"""Appends to a stored matrix: lost ones, racing ones, their indexes."""

import pytest
from data import table

from edgeworks.sources import MatrixLog

KIND = "index bigint, vector array<double>"


def rows(spark, *values):
    return spark.createDataFrame([(i, [v, v + 0.5]) for i, v in enumerate(values)], KIND)


def test_index_goes_on(spark, path):
    log = MatrixLog(spark, path)
    assert table(log.read()) == [] and log.shape() == (0, 0) and log.entries() == []
    log.append(rows(spark, 1.0, 2.0))
    log.append(rows(spark))
    log.append(rows(spark, 3.0))
    assert table(MatrixLog(spark, path).read()) == [(0, [1.0, 1.5]), (1, [2.0, 2.5]), (2, [3.0, 3.5])]
    assert log.shape() == (3, 2)
    assert [(e["first"], e["next"]) for e in log.entries()] == [(0, 2), (2, 3)]
    assert table(log.log().select("rows", "first", "next", "cols")) == [(1, 2, 3, 2), (2, 0, 2, 2)]


def test_lost_append_is_not_seen(spark, path):
    log = MatrixLog(spark, path)
    log.append(rows(spark, 1.0))
    lost = log.stage(rows(spark, 7.0, 8.0))
    log.append(rows(spark, 2.0))
    assert table(log.read()) == [(0, [1.0, 1.5]), (1, [2.0, 2.5])]
    assert f"append={lost['append']}" in log.sweep()
    assert log.sweep() == []
    assert table(log.read()) == [(0, [1.0, 1.5]), (1, [2.0, 2.5])]


def test_racing_appends_take_different_numbers(spark, path):
    one, two = MatrixLog(spark, path), MatrixLog(spark, path)
    first, second = one.stage(rows(spark, 1.0, 2.0)), two.stage(rows(spark, 3.0))
    seen = two._numbers
    # Both look at the log before either commits.
    before, stale = seen(), []

    def look():
        if not stale:
            stale.append(1)
            return before
        return seen()

    two._numbers = look
    one.commit(first)
    assert two.commit(second)["first"] == 2
    assert table(one.read()) == [(0, [1.0, 1.5]), (1, [2.0, 2.5]), (2, [3.0, 3.5])]
    with pytest.raises(ValueError):
        one.commit(second)


def test_negative_index_is_refused(spark, path):
    with pytest.raises(ValueError):
        MatrixLog(spark, path).append(spark.createDataFrame([(-1, [1.0])], KIND))
