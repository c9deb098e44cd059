import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeworks.operators import matrix

ROWS = "index bigint, vector array<double>"


def rows(spark, block):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(block)], ROWS).repartition(3)


def back(df, column="vector"):
    return np.array([row[column] for row in df.orderBy("index").collect()])


RNG = np.random.default_rng(0)
A, B = RNG.random((17, 11)), RNG.random((11, 6))


@pytest.mark.parametrize("how", [
    {"strategy": "broadcast"},
    {"strategy": "shuffle", "block": 4},
    {"strategy": "shuffle", "block": 100},
    {"strategy": "auto", "broadcast_bytes": 8, "block": 5},
], ids=str)
def test_product(spark, how):
    assert np.allclose(back(matrix.matmul(rows(spark, A), rows(spark, B), **how)), A @ B)


def test_large_b_is_not_broadcast(spark):
    plan = matrix.matmul(rows(spark, A), rows(spark, B), "broadcast", broadcast_bytes=100)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in text and "CoGroup" in text


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_square_and_vector(spark, strategy):
    s = RNG.random((7, 7))
    both = matrix.square(rows(spark, s), strategy)
    assert np.allclose(back(both), s) and np.allclose(back(both, "squared_vector"), s @ s)
    b = RNG.random((11, 1))
    assert np.allclose(back(matrix.matvec(rows(spark, A), rows(spark, b), strategy), "value"), (A @ b)[:, 0])


def test_gaps_in_the_rows_of_a(spark):
    a = rows(spark, A).filter("index % 5 = 2")
    for strategy in ("broadcast", "shuffle"):
        assert np.allclose(back(matrix.matmul(a, rows(spark, B), strategy, block=4)), (A @ B)[2::5])


def test_sizes_that_do_not_meet(spark):
    a, b = rows(spark, A), rows(spark, B[:8])
    with pytest.raises(Exception, match="every row must have 8 cells"):
        matrix.matmul(a, b).collect()
    a, b = matrix.conform(a, b)
    assert np.allclose(back(matrix.matmul(a, b)), A[:, :8] @ B[:8])


def test_index_of_b_must_count(spark):
    with pytest.raises(ValueError, match="index of B"):
        matrix.matmul(rows(spark, A), rows(spark, B).filter("index > 0"), "broadcast")
    with pytest.raises(ValueError, match="strategy"):
        matrix.matmul(rows(spark, A), rows(spark, B), "magic")


def test_cells_and_back(spark):
    m = rows(spark, A)
    assert np.allclose(back(matrix.from_cells(matrix.cells(m), 11)), A)
    assert np.allclose(back(matrix.from_cells(matrix.cells(m).filter("col != 3"), 11))[:, 3], 0)


def test_shape_and_slices(spark):
    m = rows(spark, A)
    assert tuple(matrix.matrix_shape(m).first()) == (17, 11)
    assert tuple(matrix.matrix_shape(m.limit(0)).first()) == (0, 0)
    assert np.allclose(back(matrix.row_slice(m, 3, 6)), A[3:6])
    assert np.allclose(back(matrix.head_cells(m, 4)), A[:, :4])
    assert matrix.normalize_matrix(m.withColumnRenamed("vector", "_c1")).columns == ["index", "vector"]


@pytest.mark.parametrize("options", [{"strategy": "broadcast"}, {"strategy": "shuffle", "block": 4}, {"broadcast_bytes": 8, "block": 4}])
def test_both_ways_refuse_the_same(spark, options):
    a = np.arange(24.0).reshape(3, 8)
    with pytest.raises(ValueError, match="every row must have 4 cells"):
        matrix.matmul(rows(spark, a), rows(spark, np.ones((4, 2))), **options)
    b = rows(spark, np.ones((8, 2)))
    with pytest.raises(ValueError, match="index of B"):
        matrix.matmul(rows(spark, a), b.withColumn("index", F.col("index") + 4), **options)
    with pytest.raises(ValueError, match="index of B"):
        matrix.matmul(rows(spark, a), b.withColumn("index", F.when(F.col("index") == 2, 1).otherwise(F.col("index"))), **options)
