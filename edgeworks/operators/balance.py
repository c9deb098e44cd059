"""How the rows of a scan fall to tasks and machines."""

from __future__ import annotations

import socket
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_by_task(df: DataFrame) -> DataFrame:
    """``partition, host, rows``: one row for each task that read rows.

    A task says where it ran in its own result row, not through an accumulator:
    Spark takes the result of one attempt of each task, so a task that was
    retried or run twice counts once. Tasks without rows give none.
    """

    def count(batches: Iterable) -> Iterator:
        import pyarrow as pa

        rows, partition = 0, None
        for batch in batches:
            if batch.num_rows:
                partition = batch.column(0)[0].as_py()
                rows += batch.num_rows
        if rows:
            yield pa.RecordBatch.from_pydict(
                {"partition": [partition], "host": [socket.gethostname()], "rows": [rows]},
                schema=pa.schema([("partition", pa.int32()), ("host", pa.string()), ("rows", pa.int64())]),
            )

    # One number a row goes to Python; no column of the table is read for it.
    marked = df.select(F.spark_partition_id().alias("partition"))
    return marked.mapInArrow(count, "partition int, host string, rows bigint")


def rows_per_host(df: DataFrame) -> DataFrame:
    """``host, tasks, rows``: the share of the scan that each machine took."""
    return rows_by_task(df).groupBy("host").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum("rows").alias("rows"))
