"""Reading lines with the rejected ones set aside: one pass, two tables.

What a reader drops is written beside what it keeps, with the file it came from
and the reason, so that good and bad rows together are all lines. A task that
is tried again commits its files once, so no line is counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions import fields


def _split(lines: DataFrame, out: str, reason: Column, good: dict[str, Column], mode: str) -> tuple[DataFrame, DataFrame]:
    rows = lines.select(reason.alias("reason"), F.col("_metadata.file_path").alias("file"), "value", *[c.alias(k) for k, c in good.items()])
    bad = F.col("reason").isNotNull()
    kept = [F.when(~bad, F.col(k)).alias(k) for k in good]
    aside = [F.when(bad, F.col(k)).alias(k) for k in ("file", "value")]
    done = rows.select(bad.alias("bad"), "reason", *aside, *kept)
    done.write.mode(mode).partitionBy("bad").parquet(out)
    read = lines.sparkSession.read.schema(done.schema).parquet(out)
    return read.filter(~F.col("bad")).select(*good), read.filter("bad").select("file", F.col("value").alias("line"), "reason")


def quarantine_edges(
    spark: SparkSession, path: str, out: str, sep: str = " ", id_type: str = "string", mode: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """``(src, dst)`` of good lines and ``(file, line, reason)`` of bad ones, both stored below ``out``.

    A line is good when ``read_edge_list`` keeps it.
    """
    parts = fields("value", sep)
    src, dst = (F.get(parts, i).try_cast(id_type) for i in (0, 1))
    reason = (
        F.when(F.size(parts) != 2, F.concat(F.size(parts).cast("string"), F.lit(" fields, not 2")))
        .when(src.isNull(), F.lit(f"src is no {id_type}"))
        .when(dst.isNull(), F.lit(f"dst is no {id_type}"))
    )
    return _split(spark.read.text(path), out, reason, {"src": src, "dst": dst}, mode)


def quarantine_links(
    spark: SparkSession, path: str, out: str, score_type: str = "int", header: str | None = None, mode: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """``(src, dst, score)`` of good lines and ``(file, line, reason)`` of bad ones, both stored below ``out``.

    A line is good when ``read_scored_links`` keeps it under ``on_bad="drop"``;
    lines equal to ``header`` are neither.
    """
    lines = spark.read.text(path)
    if header is not None:
        lines = lines.filter(F.col("value") != header)
    parts = fields("value")
    score = F.get(parts, F.lit(2)).try_cast(score_type)
    reason = F.when(F.size(parts) != 3, F.concat(F.size(parts).cast("string"), F.lit(" fields, not 3"))).when(
        score.isNull(), F.lit(f"score is no {score_type}"))
    good = {"src": F.get(parts, F.lit(0)), "dst": F.get(parts, F.lit(1)), "score": score}
    return _split(lines, out, reason, good, mode)
