"""Readers for edge lists, scored links, MatrixMarket files and row matrices.

Line formats are parsed with column functions on the splittable text or CSV
scan, so a file of any size is read by all tasks and no line visits Python.
"""

from __future__ import annotations

from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions import fields, parse_vector
from edgeworks.operators.graph import canonical_edges


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines of a saved text result, as ``rows``."""
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("rows"))


def _reject(what: str, line: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"bad {what} line: "), line))


def read_edge_list(
    spark: SparkSession,
    path: str,
    sep: str = " ",
    id_type: str = "string",
    on_bad: str = "drop",
    attr: int | None = None,
    names: tuple[str, str] = ("src", "dst"),
) -> DataFrame:
    """Edges from lines of exactly two fields.

    ``sep`` is a regular expression. A line is bad when it does not have two
    fields or an id does not fit ``id_type``; bad lines are dropped, or fail
    the job with ``on_bad="fail"``. ``attr`` adds a constant edge attribute.
    """
    if on_bad not in ("drop", "fail"):
        raise ValueError(f"on_bad must be drop or fail, not {on_bad!r}")
    parts = fields("value", sep)
    ends = [F.get(parts, i).try_cast(id_type) for i in (0, 1)]
    good = (F.size(parts) == 2) & ends[0].isNotNull() & ends[1].isNotNull()
    lines = spark.read.text(path)
    if on_bad == "drop":
        lines = lines.filter(good)
    else:
        ends[0] = F.when(good, ends[0]).otherwise(_reject("edge", F.col("value")).cast(id_type))
    columns = [end.alias(name) for end, name in zip(ends, names)]
    if attr is not None:
        columns.append(F.lit(attr).alias("attr"))
    return lines.select(*columns)


def read_scored_links(
    spark: SparkSession,
    path: str,
    score_type: str = "int",
    on_bad: str = "fail",
    min_score: float | None = None,
    header: str | bool = True,
) -> DataFrame:
    """Links ``src, dst, score`` from lines of fields between white space.

    Lines equal to the header are left out wherever they stand; ``header`` is
    that line, or True for the first line of the first file, or False for none.
    A line is bad when it has fewer than three fields or its score does not fit
    ``score_type``. ``on_bad="fail"`` stops the job on a bad line and ignores
    extra fields; ``on_bad="drop"`` is the strict check: it keeps only lines of
    exactly three good fields. Selecting ``src, dst`` alone gives unscored
    links.
    """
    if on_bad not in ("drop", "fail"):
        raise ValueError(f"on_bad must be drop or fail, not {on_bad!r}")
    lines = spark.read.text(path)
    if header is True:
        files = sorted(lines.inputFiles())
        found = spark.read.text(unquote(files[0])).first() if files else None
        header = found["value"] if found else False
    if header is not False:
        lines = lines.filter(F.col("value") != header)
    parts = fields("value")
    score = F.get(parts, F.lit(2)).try_cast(score_type)
    if on_bad == "drop":
        lines = lines.filter((F.size(parts) == 3) & score.isNotNull())
    else:
        good = (F.size(parts) >= 3) & score.isNotNull()
        score = F.when(good, score).otherwise(_reject("link", F.col("value")).cast(score_type))
    links = lines.select(F.get(parts, F.lit(0)).alias("src"), F.get(parts, F.lit(1)).alias("dst"), score.alias("score"))
    return links if min_score is None else links.filter(F.col("score") >= min_score)


def read_table(spark: SparkSession, path: str, schema: str, sep: str = " ") -> DataFrame:
    """A delimited table with a header. The schema is given, so the file is
    not read twice to infer one."""
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def read_mtx_edges(spark: SparkSession, path: str, orientation: str = "canonical") -> DataFrame:
    """Edges of a MatrixMarket coordinate file.

    Comment lines and the three-number size line are left out.
    ``orientation="upper"`` keeps entries with ``src < dst`` as they stand;
    ``"canonical"`` also turns the others round and removes copies, so that an
    edge stored only as ``src > dst`` is not lost.
    """
    lines = spark.read.text(path).filter(~F.col("value").startswith("%"))
    parts = fields("value")
    edges = lines.filter(F.size(parts) == 2).select(
        *[F.get(parts, i).cast("bigint").alias(name) for i, name in enumerate(("src", "dst"))]
    )
    if orientation not in ("upper", "canonical"):
        raise ValueError(f"orientation must be upper or canonical, not {orientation!r}")
    return canonical_edges(edges, orientation)


def read_matrix_csv(spark: SparkSession, path: str) -> DataFrame:
    """``index bigint, vector array<double>`` from a CSV file with a header.

    The second column is the vector whatever its header says.
    """
    rows = spark.read.schema("index bigint, vector string").option("header", True).csv(path)
    return rows.select("index", parse_vector("vector").alias("vector"))


def read_matrix_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``index, vector`` from Parquet."""
    return spark.read.parquet(path).select("index", "vector")


def table_shape(spark: SparkSession, path: str, read=read_matrix_csv) -> DataFrame:
    """Rows and columns of a saved matrix; 0, 0 when it cannot be read.

    A missing path, one without a matrix, and a file that is no Parquet file
    cannot be read, also when only the scan finds that out; so the one row is
    counted here. Any other failure of the job is raised.
    """
    shape = "rows bigint, cols bigint"
    cols = F.coalesce(F.max(F.size("vector")), F.lit(0)).cast("bigint")
    try:
        found = read(spark, path).agg(F.count(F.lit(1)).alias("rows"), cols.alias("cols")).first()
    except AnalysisException:
        return spark.createDataFrame([(0, 0)], shape)
    except (PySparkException, Py4JJavaError) as error:
        # The first when the schema is read, the second when only the scan meets the file.
        if not any(sign in str(error) for sign in ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file")):
            raise
        return spark.createDataFrame([(0, 0)], shape)
    return spark.createDataFrame([tuple(found)], shape)
