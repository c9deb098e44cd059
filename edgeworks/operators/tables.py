"""Small table jobs: word count, joins, top-k, row numbers, scan balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.functions import tokens
from edgeworks.loop import Workspace


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """``word, count`` over the pieces between single spaces."""
    words = df.select(F.explode(tokens(column)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def join_on(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Inner join on shared columns, which appear once in the result."""
    return left.join(right, key)


def ordered(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Rows from the largest ``column`` down, ties by the other columns."""
    return df.orderBy(F.desc(column), *ties)


def top_k(df: DataFrame, column: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the largest ``column``."""
    return ordered(df, column, *ties).limit(k)


def is_empty(df: DataFrame) -> bool:
    """True when there is no row; reads at most one."""
    return df.isEmpty()


def rows_per_partition(df: DataFrame) -> DataFrame:
    """``partition, rows``: how evenly a scan is spread over tasks."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def with_row_index(df: DataFrame, *order_by: str) -> DataFrame:
    """Rows with ``row_index`` 0, 1, 2, … in the given order.

    The sorted rows are written once with their place inside their sorted
    part; adding the sizes of the parts before gives the index. Only one
    number per part reaches the driver. Rows equal in ``order_by`` follow by a
    hash of all columns and their place, so many equal keys are still divided
    over several parts.
    """
    work = Workspace(df.sparkSession)
    ties = F.xxhash64(*df.columns), F.monotonically_increasing_id()
    placed = df.orderBy(*order_by, *ties).withColumn("place", F.monotonically_increasing_id())
    placed, _ = work.keep(placed, "sorted")
    part = F.shiftright("place", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    offsets, before = [], 0
    for row in sizes:
        offsets.append((row["part"], before))
        before += row["n"]
    starts = df.sparkSession.createDataFrame(offsets, "part bigint, start bigint")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(starts), "part")
        .withColumn("row_index", F.col("start") + inside)
        .drop("part", "place", "start")
    )
