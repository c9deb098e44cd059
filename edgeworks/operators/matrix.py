"""Dense row matrices ``index bigint, vector array<double>``.

``index`` counts rows from 0. Cells are multiplied in blocks by numpy inside
the tasks; Spark partitions, replicates and sums the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_SCHEMA = "index bigint, vector array<double>"
# A matrix up to this size is sent to every task; a larger one is shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK = 1024
TALL = 8


def normalize_matrix(df: DataFrame) -> DataFrame:
    """The second column named ``vector`` when no column is."""
    return df if "vector" in df.columns else df.withColumnRenamed(df.columns[1], "vector")


def as_doubles(matrix: DataFrame) -> DataFrame:
    """``index`` as bigint and cells as double."""
    return matrix.select(F.col("index").cast("bigint"), F.col("vector").cast("array<double>"))


def matrix_shape(matrix: DataFrame) -> DataFrame:
    """``rows, cols`` in one row."""
    cols = F.coalesce(F.max(F.size("vector")), F.lit(0)).cast("bigint")
    return matrix.agg(F.count(F.lit(1)).alias("rows"), cols.alias("cols"))


def row_slice(matrix: DataFrame, start: int, end: int) -> DataFrame:
    """Rows with ``start <= index < end``."""
    return matrix.filter((F.col("index") >= start) & (F.col("index") < end))


def head_rows(matrix: DataFrame, n: int) -> DataFrame:
    """The first n rows by index."""
    return row_slice(matrix, 0, n)


def head_cells(matrix: DataFrame, n: int) -> DataFrame:
    """Each row cut to its first n cells."""
    return matrix.withColumn("vector", F.slice("vector", 1, n))


def cells(matrix: DataFrame) -> DataFrame:
    """``index, col, value``: one row per cell."""
    long = matrix.select("index", F.posexplode("vector").alias("col", "value"))
    return long.select("index", F.col("col").cast("bigint"), "value")


def from_cells(cells: DataFrame, cols: int) -> DataFrame:
    """A dense matrix from ``index, col, value``; missing cells are 0."""
    at = F.map_from_entries(F.collect_list(F.struct(F.col("col").cast("int").alias("col"), "value")))
    grouped = cells.groupBy("index").agg(at.alias("at"))
    vector = F.transform(
        F.sequence(F.lit(0), F.lit(cols - 1)), lambda j: F.coalesce(F.try_element_at("at", j), F.lit(0.0)))
    return grouped.select("index", vector.alias("vector"))


def conform(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both matrices cut to the inner dimension they share."""
    cols_a, rows_b = matrix_shape(a).first()["cols"], matrix_shape(b).first()["rows"]
    inner = min(cols_a, rows_b)
    return head_cells(a, inner), head_rows(b, inner)


def matmul(
    a: DataFrame,
    b: DataFrame,
    strategy: str = "auto",
    block: int = BLOCK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``index, vector``: the product A·B, rows in the order of A's index.

    ``"auto"`` sends B to the tasks when its measured size is within
    ``broadcast_bytes`` and shuffles blocks otherwise; ``"shuffle"`` always
    shuffles, and ``"broadcast"`` is a hint: a larger B is shuffled all the
    same. Both ways give the same rows and refuse the same inputs: B's index must count its rows from 0, its rows must be of one
    length, and every row of A must have as many cells as B has rows.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"strategy must be auto, broadcast or shuffle, not {strategy!r}")
    a, b = as_doubles(a), as_doubles(b)
    right, left = _measured(b, distinct=True), _measured(a)
    _check_product(left, right)
    rows, cols = right["rows"], right["most"] or 0
    fits = rows * cols * 8 <= broadcast_bytes
    if fits and strategy != "shuffle":
        return _times_small(a, b)
    return _times_blocks(a, b, rows, cols, left["rows"], block)


def _measured(matrix: DataFrame, distinct: bool = False):
    """Rows, bounds of the index and of the row lengths, in one pass."""
    size = F.coalesce(F.size("vector"), F.lit(-1))
    found = [F.count(F.lit(1)).alias("rows"), F.min("index").alias("first"), F.max("index").alias("last"), F.min(size).alias("least"), F.max(size).alias("most")]
    return matrix.agg(*found, *([F.count_distinct("index").alias("indexes")] if distinct else [])).first()


def _check_product(a, b) -> None:
    """Refuse what cannot be multiplied, by the measures of both matrices."""
    if b["rows"] and not (b["first"] == 0 and b["last"] == b["rows"] - 1 and b["indexes"] == b["rows"]):
        raise ValueError("the index of B must count its rows from 0")
    if b["rows"] and b["least"] != b["most"]:
        raise ValueError("every row of B must have the same number of cells")
    if a["rows"] and not a["least"] == a["most"] == b["rows"]:
        raise ValueError(f"every row must have {b['rows']} cells")


def square(a: DataFrame, strategy: str = "auto", **options) -> DataFrame:
    """``index, vector, squared_vector``: A next to A·A."""
    product = matmul(a, a, strategy, **options)
    return as_doubles(a).join(product.withColumnRenamed("vector", "squared_vector"), "index")


def matvec(a: DataFrame, b: DataFrame, strategy: str = "auto", **options) -> DataFrame:
    """``index, value``: A times a matrix of one column."""
    product = matmul(a, b, strategy, **options)
    return product.select("index", F.get("vector", F.lit(0)).alias("value"))


def _codecs():
    """Arrow lists to numpy and back.

    Made inside a function, so that they travel with the task and the workers
    need numpy and pyarrow but not this package.
    """

    def dense(vectors, cols: int) -> np.ndarray:
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        if not (sizes == cols).all():
            raise ValueError(f"every row must have {cols} cells")
        return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), cols)

    def lists(block: np.ndarray) -> pa.Array:
        rows, cols = block.shape
        offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * np.int32(cols))
        return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(block).ravel()))

    return dense, lists


def _times_small(a: DataFrame, b: DataFrame) -> DataFrame:
    """A·B with B, whose size was checked, in every task."""
    rows = b.orderBy("index").toArrow()
    index = rows.column("index").to_numpy()
    if not np.array_equal(index, np.arange(len(index))):
        raise ValueError("the index of B must count its rows from 0")
    vectors = rows.column("vector").combine_chunks()
    width = len(vectors[0]) if len(vectors) else 0
    dense, lists = _codecs()
    small = a.sparkSession.sparkContext.broadcast(dense(vectors, width))

    def times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = small.value
        for batch in batches:
            left = dense(batch.column(1), right.shape[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(left @ right)], ["index", "vector"])

    return a.mapInArrow(times, ROWS_SCHEMA)


def _pieces(vector: str, width: int):
    """A row cut into numbered pieces of ``width`` cells."""
    n = F.ceil(F.size(vector) / F.lit(width)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(i.alias("piece"), F.slice(vector, i * width + 1, F.lit(width)).alias("cells")))


def _copies(df: DataFrame, name: str, n: int, step: int = 1000) -> DataFrame:
    """Every row n times, numbered; in two steps, so no long array is built."""
    outer = df.withColumn("outer", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // step))))
    first = F.col("outer") * step
    inner = F.sequence(first, F.least(first + (step - 1), F.lit(n - 1)))
    return outer.withColumn(name, F.explode(inner)).drop("outer")


def _times_blocks(a: DataFrame, b: DataFrame, inner: int, cols: int, rows: int, block: int) -> DataFrame:
    """A·B by blocks, each pair of blocks in a task of its own group.

    A block of A goes to each column of blocks of B and the other way round,
    so a group holds two blocks, whatever the size of the matrices. Blocks of
    A are up to ``TALL`` times as high as wide where A has the rows for it,
    so B is copied less often. The products are summed per row, then joined to
    whole rows.
    """
    if not inner or not cols:
        return a.select("index", F.array().cast("array<double>").alias("vector"))
    wide = -(-cols // block)
    height = block * max(1, min(TALL, rows // (block * TALL)))
    left = a.select(
        F.floor(F.col("index") / height).alias("bi"), "index", F.inline(_pieces("vector", block)))
    left = _copies(left.withColumnRenamed("piece", "bk"), "bj", wide)
    right = b.select(
        F.floor(F.col("index") / block).cast("int").alias("bk"),
        (F.col("index") % block).cast("int").alias("row"),
        F.inline(_pieces("vector", block)),
    ).withColumnRenamed("piece", "bj")
    # Copies only for the row blocks that A has.
    met = a.select(F.floor(F.col("index") / height).alias("bi")).distinct()
    every = met.withColumn("bk", F.explode(F.sequence(F.lit(0), F.lit((inner - 1) // block))))
    right = right.join(every, "bk")

    dense, lists = _codecs()
    empty = pa.schema([
        ("index", pa.int64()), ("bj", pa.int32()), ("bk", pa.int32()), ("cells", pa.list_(pa.float64()))]).empty_table()
    # After the checks only B can lack a partner: a row block of A is met by all of B.

    def times(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty
        if not right.num_rows:
            raise ValueError("a block of A has no partner in B")
        right = right.sort_by("row")
        b_block = dense(right.column("cells"), len(right.column("cells")[0]))
        a_block = dense(left.column("cells"), len(b_block))
        n = left.num_rows
        return pa.table([
            left.column("index"),
            pa.array([key[1].as_py()] * n, pa.int32()),
            pa.array([key[2].as_py()] * n, pa.int32()),
            lists(a_block @ b_block),
        ], names=["index", "bj", "bk", "cells"])

    parts = left.groupBy("bi", "bj", "bk").cogroup(right.groupBy("bi", "bj", "bk")).applyInArrow(
        times, "index bigint, bj int, bk int, cells array<double>")
    ordered = F.sort_array(F.collect_list(F.struct("bk", "cells")))
    total = F.aggregate(
        F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))),
        F.get(ordered, F.lit(0))["cells"],
        lambda acc, part: F.zip_with(acc, part["cells"], lambda x, y: x + y),
    )
    summed = parts.groupBy("index", "bj").agg(total.alias("cells"))
    whole = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("bj", "cells"))), lambda s: s["cells"]))
    return summed.groupBy("index").agg(whole.alias("vector"))

