"""Text, CSV and Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions import edge_text, format_vector


def _writer(df: DataFrame, mode: str, compression: str | None, files: int | None):
    writer = (df if files is None else df.repartition(files)).write.mode(mode)
    return writer if compression is None else writer.option("compression", compression)


def write_lines(
    df: DataFrame,
    path: str,
    mode: str = "error",
    compression: str | None = None,
    files: int | None = None,
    skip_empty: bool = False,
) -> bool:
    """Write a single string column as text; False when skipped as empty."""
    if skip_empty and df.isEmpty():
        return False
    _writer(df, mode, compression, files).text(path)
    return True


def write_edges(df: DataFrame, path: str, sep: str = ",", **options) -> bool:
    """Write ``src, dst`` as text lines; rows with a missing end are left out."""
    lines = df.dropna(subset=["src", "dst"]).select(edge_text(sep=sep).alias("value"))
    return write_lines(lines, path, **options)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    header: bool = False,
    compression: str | None = None,
    files: int | None = None,
    skip_empty: bool = False,
) -> bool:
    """Write flat columns as CSV; False when skipped as empty."""
    if skip_empty and df.isEmpty():
        return False
    _writer(df, mode, compression, files).option("header", header).csv(path)
    return True


def write_matrix_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> bool:
    """Write a matrix as CSV with the vectors as text.

    Every part has a header, appended ones too, which is what
    ``read_matrix_csv`` expects.
    """
    arrays = [name for name, kind in df.dtypes if kind.startswith("array")]
    flat = df.withColumns({name: format_vector(name) for name in arrays})
    return write_csv(flat, path, mode=mode, header=True, **options)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Write a DataFrame as Parquet."""
    _writer(df, mode, None, files).parquet(path)


def append_rows(spark: SparkSession, path: str, new_rows: DataFrame) -> DataFrame:
    """Append matrix rows (``index`` from 0) to a stored CSV matrix.

    The index goes on after the last stored row. Only new files are written;
    the stored ones are never rewritten. Returns the grown matrix.
    """
    from edgeworks.sources.readers import read_matrix_csv

    last = read_matrix_csv(spark, path).agg(F.max("index")).first()[0]
    offset = 0 if last is None else last + 1
    write_matrix_csv(new_rows.withColumn("index", F.col("index") + F.lit(offset)), path, mode="append")
    return read_matrix_csv(spark, path)
