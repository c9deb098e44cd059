"""Queries over row matrices. Results are compared cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.functions import dot
from edgeworks.operators import matrix
from edgeworks.plans.inputs import (
    EMBEDDING_CELLS,
    LABEL_CELLS,
    MEAN_CELLS,
    TRADE_CELLS,
    embedding_matrix,
    label_weights,
    mean_column,
    trade_matrix,
)
from edgeworks.plans.registry import query


def _cells(m: DataFrame, digits: int = 6) -> DataFrame:
    return matrix.cells(m).select("index", "col", F.round("value", digits).alias("value"))


PRODUCT = f"""WITH {EMBEDDING_CELLS}, {LABEL_CELLS}
SELECT a.index, b.col, round(sum(a.value * b.value), 6) AS value
FROM embedding_cells a JOIN label_cells b ON a.col = b.index GROUP BY a.index, b.col"""


@query("matmul_broadcast", PRODUCT)
def _(spark, d):
    return _cells(matrix.matmul(embedding_matrix(spark, d), label_weights(spark, d), "broadcast"))


@query("matmul_shuffle", PRODUCT)
def _(spark, d):
    # Small blocks, so that several meet in every row and column.
    return _cells(matrix.matmul(embedding_matrix(spark, d), label_weights(spark, d), "shuffle", block=48))


@query("matvec", f"""WITH {EMBEDDING_CELLS}, {MEAN_CELLS}
SELECT a.index, round(sum(a.value * b.value), 6) AS value
FROM embedding_cells a JOIN mean_cells b ON a.col = b.index GROUP BY a.index""")
def _(spark, d):
    product = matrix.matvec(embedding_matrix(spark, d), mean_column(spark, d))
    return product.select("index", F.round("value", 6).alias("value"))


@query("matrix_square", f"""WITH {TRADE_CELLS}, squared AS (
  SELECT a.index, b.col, sum(a.value * b.value) AS squared FROM trade_cells a JOIN trade_cells b ON a.col = b.index
  GROUP BY a.index, b.col)
SELECT index, col, round(value, 3) AS value, round(squared, 3) AS squared FROM trade_cells JOIN squared USING (index, col)""")
def _(spark, d):
    squared = matrix.square(trade_matrix(spark, d))
    both = squared.select("index", F.posexplode(F.arrays_zip("vector", "squared_vector")).alias("col", "pair"))
    return both.select(
        "index", F.col("col").cast("bigint"), F.round("pair.vector", 3).alias("value"), F.round("pair.squared_vector", 3).alias("squared"))


@query("matrix_conform", f"""WITH {EMBEDDING_CELLS}, {TRADE_CELLS}
SELECT a.index, b.col, round(sum(a.value * b.value), 4) AS value
FROM embedding_cells a JOIN trade_cells b ON a.col = b.index
GROUP BY a.index, b.col""")
def _(spark, d):
    # 64 columns meet 25 rows; both are cut to 25.
    a, b = matrix.conform(embedding_matrix(spark, d), trade_matrix(spark, d))
    return _cells(matrix.matmul(a, b), digits=4)


@query("matrix_shape", "SELECT count(*) AS rows, max(len(embedding)) AS cols FROM embeddings")
def _(spark, d):
    return matrix.matrix_shape(embedding_matrix(spark, d))


@query("row_slice", f"""WITH {EMBEDDING_CELLS} SELECT index, col, round(value, 6) AS value
FROM embedding_cells WHERE index >= 100 AND index < 150""")
def _(spark, d):
    return _cells(matrix.row_slice(embedding_matrix(spark, d), 100, 150))


@query("head_rows", f"""WITH {EMBEDDING_CELLS} SELECT index, col, round(value, 6) AS value
FROM embedding_cells WHERE index < 20""")
def _(spark, d):
    return _cells(matrix.head_rows(embedding_matrix(spark, d), 20))


@query("head_cells", f"""WITH {EMBEDDING_CELLS} SELECT index, col, round(value, 6) AS value
FROM embedding_cells WHERE col < 16""")
def _(spark, d):
    return _cells(matrix.head_cells(embedding_matrix(spark, d), 16))


@query("row_dot", f"""WITH {EMBEDDING_CELLS} SELECT index, round(sum(value * value), 6) AS value
FROM embedding_cells GROUP BY index""")
def _(spark, d):
    return embedding_matrix(spark, d).select("index", F.round(dot("vector", "vector"), 6).alias("value"))


@query("normalize_matrix", f"""WITH {EMBEDDING_CELLS} SELECT index, col, round(value, 6) AS value FROM embedding_cells""")
def _(spark, d):
    named = embedding_matrix(spark, d).withColumnRenamed("vector", "_c1")
    return _cells(matrix.normalize_matrix(named))


@query("product_column", PRODUCT.replace("6) AS value", "6) AS product"))
def _(spark, d):
    product = matrix.matmul(embedding_matrix(spark, d), label_weights(spark, d))
    return _cells(product.withColumnRenamed("vector", "multiplied_vector").select(
        "index", F.col("multiplied_vector").alias("vector"))).withColumnRenamed("value", "product")


@query("matrix_listing", """SELECT vec_id AS index, len(embedding)::INT AS cells FROM embeddings ORDER BY vec_id LIMIT 10""")
def _(spark, d):
    rows = embedding_matrix(spark, d).orderBy("index").limit(10)
    return rows.select("index", F.size("vector").alias("cells"))
