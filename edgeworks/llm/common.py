"""Helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one piece of a batch may hold while Python works on it.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` alone, a null text read as an empty one.

    Columns that an operator does not need never reach it, so theirs may have
    any name.
    """
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def sliced(batches: Iterable[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``size`` bytes, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, rows * size // max(1, batch.nbytes))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``df.mapInArrow`` with a function of one piece of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in sliced(batches):
            yield fn(piece)

    return df.mapInArrow(run, schema)


#: Rows that go to Python at once in jobs that run inside ``small_batches``.
SMALL_BATCH = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows go to Python at once, so that an executor and its workers hold less of their texts.

    For jobs that run inside the block. The setting of the session is never raised, and is back at the end.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    if 0 < int(usual) <= SMALL_BATCH:
        yield
        return
    spark.conf.set(name, str(SMALL_BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies, unless its path was given."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def parts_for(total: int, each: int, least: int) -> int:
    """So many partitions that one gets about ``each`` of ``total``."""
    return max(least, -(-total // each))
