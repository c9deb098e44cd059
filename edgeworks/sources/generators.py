"""Random edges and matrices made by the tasks, never by the driver.

Cells are hashes of (seed, row, column): the same seed gives the same data
whatever the number of partitions, and a task that is run again writes the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions import hash60, scaled_int, uniform


def edges_for(rows: DataFrame, key: str, max_id: int = 1_000_000, seed: int = 0) -> DataFrame:
    """One edge for each row, with string ids uniform in 1..max_id, drawn from the row's ``key``."""
    ends = [
        (F.pmod(hash60(f"{seed}-{name}", key), F.lit(max_id)) + 1).cast("string").alias(name)
        for name in ("src", "dst")
    ]
    return rows.select(*ends)


def random_edges(
    spark: SparkSession, n: int, max_id: int = 1_000_000, partitions: int | None = None, seed: int = 0
) -> DataFrame:
    """``n`` edges with string ids uniform in 1..max_id."""
    return edges_for(spark.range(0, n, 1, partitions), "id", max_id, seed)


def matrix_for(rows: DataFrame, key: str, cols: int, seed: int = 0, scale: int | None = None) -> DataFrame:
    """``index, vector``: a matrix row for each row, drawn from its ``key``, which is the index.

    Cells are in [0, 1), or integers below ``scale``.
    """

    def cell(j):
        x = uniform(seed, F.col("index"), j)
        return x if scale is None else scaled_int(x, scale)

    index = rows.select(F.col(key).alias("index"))
    return index.select("index", F.transform(F.sequence(F.lit(0), F.lit(cols - 1)), cell).alias("vector"))


def random_matrix(
    spark: SparkSession,
    rows: int,
    cols: int,
    partitions: int | None = None,
    seed: int = 0,
    scale: int | None = None,
) -> DataFrame:
    """``index, vector`` with cells in [0, 1), or integers below ``scale``."""
    return matrix_for(spark.range(0, rows, 1, partitions), "id", cols, seed, scale)
