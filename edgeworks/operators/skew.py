"""Joins that stay balanced when one key holds a large share of the rows.

A key is hot when it has more than ``ROWS_PER_SLOT`` rows, whatever the size of
the table, so there are fewer than (all rows / ``ROWS_PER_SLOT``) hot keys. The
rows of a hot key are divided over as many slots as keep a slot at about that
many rows, by a hash of given columns or, where copies are to be parted as
well, by their place; the one row of the other side is copied to each slot. The
list of hot keys is a written table, which Spark broadcasts if its size allows
and joins by shuffle if not. Every row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import Workspace

ROWS_PER_SLOT = 1_000_000
#: Buckets that keys are hashed to before they are counted one by one.
BUCKETS = 65_536


def hot_keys(rows: DataFrame, key: str, min_rows: int | None = None, count: str | None = None) -> DataFrame | None:
    """Hot keys as ``(key, slots)``, or None when there are none.

    ``count`` names a column that already holds the rows per key; ``min_rows``
    is used in place of ``ROWS_PER_SLOT``. Without it the rows of hashed buckets
    are counted first: a hot key makes its bucket hot, so only the keys of hot
    buckets are counted one by one, and mostly there are none.
    """
    limit = max(1, ROWS_PER_SLOT if min_rows is None else min_rows)
    work = Workspace(rows.sparkSession)
    if count is None:
        bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS).cast("bigint")).cast("int")
        sums = rows.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        full, seen = work.keep(sums.filter(F.col("n") > limit).select("bucket"), "buckets")
        if not seen.get("rows"):
            work.drop(full)
            return None
        rows = rows.select(key, bucket.alias("bucket")).join(F.broadcast(full), "bucket", "left_semi")
        per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    else:
        per_key = rows.select(key, F.col(count).alias("n"))
    hot = per_key.filter(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("slots"))
    found, seen = work.keep(hot, "hot")
    if seen.get("rows"):
        return found
    work.drop(found)
    return None


def with_slot(rows: DataFrame, key: str, hot: DataFrame | None, by: list[str] | None) -> DataFrame:
    """Rows with a ``slot``: 0, or one of the key's slots when it is hot.

    The slot is a hash of ``by``; without columns the place of the row decides,
    so that equal rows are divided too.
    """
    if hot is None:
        return rows
    slots = hot.withColumnRenamed(hot.columns[0], key)
    place = F.xxhash64(*by) if by else F.monotonically_increasing_id()
    placed = rows.withColumn("place", place).join(slots, key, "left")
    slot = F.pmod(F.col("place"), F.col("slots")).cast("int")
    return placed.withColumn("slot", F.coalesce(slot, F.lit(0))).drop("slots", "place")


def fan_out(rows: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Rows copied to every slot of their key."""
    if hot is None:
        return rows
    slots = hot.withColumnRenamed(hot.columns[0], key)
    every = F.sequence(F.lit(0), F.coalesce(F.col("slots"), F.lit(1)) - 1)
    return rows.join(slots, key, "left").withColumn("slot", F.explode(every)).drop("slots")


def slot_keys(key: str, hot: DataFrame | None) -> list[str]:
    """The join columns that go with ``with_slot`` and ``fan_out``."""
    return [key] if hot is None else [key, "slot"]


def spread_join(
    rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame | None, by: list[str] | None, how: str = "inner"
) -> DataFrame:
    """``rows.join(lookup, key, how)`` with the hot keys of ``rows`` divided.

    ``lookup`` holds each key once. ``how`` is inner, left, left_semi or
    left_anti.
    """
    joined = with_slot(rows, key, hot, by).join(fan_out(lookup, key, hot), slot_keys(key, hot), how)
    return joined if hot is None else joined.drop("slot")
