"""Driver loops over DataFrames that survive the loss of executors.

Lineage is cut by writing the loop state as Parquet into the shared checkpoint
folder of the cluster. Parquet keeps the columns compressed and gives the next
round true table sizes; the row count and any other metrics of a round are
observed while it is written, so they cost no second pass.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    # Only a single-machine session (tests) gets here.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="edgeworks-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


ROWS_PER_PART = 1_000_000
SHUFFLE_PARTS = "spark.sql.shuffle.partitions"


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[int]:
    """Fewer shuffle partitions for the rounds over a small table.

    Rounds are short, and cutting little data into the many parts a cluster is
    set up for makes them much longer. The setting of the session is never
    raised, and is back when the loop is done.
    """
    usual = spark.conf.get(SHUFFLE_PARTS)
    parts = min(int(usual), max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PART)))
    spark.conf.set(SHUFFLE_PARTS, str(parts))
    try:
        yield parts
    finally:
        spark.conf.set(SHUFFLE_PARTS, usual)


#: Bytes of a file that are one task's in wide jobs; edges of a table take 8 to 16 bytes each.
WIDE_SPLIT = "8m"


@contextmanager
def wide_shuffles(spark: SparkSession, rows: int) -> Iterator[None]:
    """As many partitions as ``rows`` need, in scans and shuffles, for jobs that run inside the block.

    With a fixed number of partitions, or partitions put together by their packed
    bytes, the sorts and hash tables of a task grow with the table. The session's
    number of partitions is never lowered; its settings are back at the end.
    Where a core has less than one part's rows to do, nothing is changed.
    """
    if rows <= ROWS_PER_PART * spark.sparkContext.defaultParallelism:
        yield
        return
    wide = {
        SHUFFLE_PARTS: str(max(int(spark.conf.get(SHUFFLE_PARTS)), -(-rows // ROWS_PER_PART))),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": WIDE_SPLIT,
    }
    usual = {name: spark.conf.get(name) for name in wide}
    try:
        for name, value in wide.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def kept_wide(df: DataFrame, rows: int, name: str) -> DataFrame:
    """``df``, written with as many partitions as ``rows`` need and read back."""
    with wide_shuffles(df.sparkSession, rows):
        return Workspace(df.sparkSession).keep(df, name)[0]


#: Shuffle files go when the job that reads them ends, not when the driver collects its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a job inside the block shuffles is deleted at its end; for jobs whose plan runs once."""
    usual = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, usual)


class Workspace:
    """The tables that one job writes for itself in the shared folder.

    Results are read from there, so it must outlive them. ``clear`` deletes
    what no result needs; as a ``with`` block the whole folder goes at the end.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/edgeworks-{uuid.uuid4().hex}"
        self._written: dict[int, tuple[DataFrame, str]] = {}
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:04d}-{name}"

    def keep(self, df: DataFrame, name: str = "step", **metrics: Column) -> tuple[DataFrame, dict]:
        """Write ``df`` and return the table read back, with its metrics.

        ``rows`` is always among the metrics.
        """
        path = self.path(name)
        seen = self._write(df, path, metrics)
        return self._table(path, df), seen

    def keep_split(
        self, df: DataFrame, flag: str, name: str = "step"
    ) -> tuple[DataFrame | None, DataFrame | None, int]:
        """Write ``df`` once, as one table where ``flag`` is true and one
        where it is false; both without the flag.

        Returns the two tables, None in place of one without rows, and the
        number of rows in the second.
        """
        path = self.path(name)
        counts = {"flagged": F.count_if(F.col(flag))}
        seen = self._write(df, path, counts, split=flag)
        plain = df.drop(flag)
        yes, no = seen.get("flagged", 0), seen.get("rows", 0) - seen.get("flagged", 0)
        return (
            self._table(f"{path}/{flag}=true", plain) if yes else None,
            self._table(f"{path}/{flag}=false", plain) if no else None,
            no,
        )

    def keep_parts(self, df: DataFrame, by: str, values: Iterable[int]) -> dict[int, DataFrame]:
        """Write ``df`` once, as a table for each of the values of ``by``.

        Returns the tables that have rows, by value and without the column.
        """
        path, values = self.path(by), list(values)
        counts = {f"n{v}": F.count_if(F.col(by) == v) for v in values}
        seen = self._write(df, path, counts, split=by)
        return {v: self._table(f"{path}/{by}={v}", df.drop(by)) for v in values if seen.get(f"n{v}")}

    def _write(self, df: DataFrame, path: str, metrics: dict[str, Column], split: str | None = None) -> dict:
        seen = Observation()
        exprs = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in metrics.items()]
        writer = df.observe(seen, *exprs).write
        # A loop would otherwise keep the shuffles of all its rounds on disk.
        with freed_shuffles(self.spark):
            (writer if split is None else writer.partitionBy(split)).parquet(path)
        return seen.get

    def _table(self, path: str, like: DataFrame) -> DataFrame:
        table = self.spark.read.schema(like.schema).parquet(path)
        self._written[id(table)] = (table, path)
        return table

    def drop(self, table: DataFrame | None) -> None:
        """Delete a table of this workspace that no later round reads.

        Anything this workspace did not write is left alone.
        """
        entry = self._written.pop(id(table), None)
        if entry is not None:
            self._delete(entry[1])

    def clear(self, *kept: DataFrame) -> None:
        """Delete every table of this workspace but those given."""
        stay = {id(x) for x in kept}
        for key in [k for k in self._written if k not in stay]:
            self._delete(self._written.pop(key)[1])

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self._written.clear()
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        where.getFileSystem(conf).delete(where, True)


def iterate(
    work: Workspace,
    state: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    max_rounds: int | None,
    stop: Callable[[dict], bool] | None = None,
    cut_every: int = 1,
    **metrics: Column,
) -> tuple[DataFrame, dict, int]:
    """Apply ``step`` until ``stop`` holds or ``max_rounds`` are done.

    ``cut_every`` rounds are planned as one job; then the state is written,
    the one before it is dropped and ``stop`` looks at the metrics. ``step``
    must use its state once, or the rounds of one job are computed repeatedly.
    """
    done, seen = 0, {}
    while max_rounds is None or done < max_rounds:
        before = state
        todo = cut_every if max_rounds is None else min(cut_every, max_rounds - done)
        for _ in range(todo):
            done += 1
            state = step(state, done)
        state, seen = work.keep(state, f"round-{done}", **metrics)
        work.drop(before)
        if stop is not None and stop(seen):
            break
    return state, seen, done
