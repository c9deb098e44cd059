"""Edge lists, links and matrices made of the test tables, whole tables each.

Every Spark definition has its SQL twin next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def part_links(spark: SparkSession, d: str) -> DataFrame:
    """One row per line item: part, supplier, quantity; many copies."""
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("p"), "l_partkey").alias("src"),
        F.concat(F.lit("s"), "l_suppkey").alias("dst"),
        F.col("l_quantity").alias("score"),
    )


PART_LINKS = """part_links AS (
  SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst, l_quantity AS score FROM lineitem)"""


def scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Part and supplier with the quantity they have in common."""
    return part_links(spark, d).groupBy("src", "dst").agg(F.sum("score").alias("score"))


SCORED_PAIRS = PART_LINKS + """, scored_pairs AS (
  SELECT src, dst, sum(score) AS score FROM part_links GROUP BY src, dst)"""


def sales_edges(spark: SparkSession, d: str) -> DataFrame:
    """Part → supplier → customer → part for every line item.

    Ids are numbers: three times the key, plus the kind of vertex. Suppliers
    are hubs, every sale is a triangle, and sales of one pair are copies.
    """
    orders = table(spark, d, "orders")
    sale = table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_partkey") * 3).alias("p"),
        (F.col("l_suppkey") * 3 + 1).alias("s"),
        (F.col("o_custkey") * 3 + 2).alias("c"),
    )
    ends = [F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in ("ps", "sc", "cp")]
    return sale.select(F.inline(F.array(*ends)))


SALES = """sale AS (
  SELECT l_partkey * 3 AS p, l_suppkey * 3 + 1 AS s, o_custkey * 3 + 2 AS c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sales AS (
  SELECT p AS src, s AS dst FROM sale UNION ALL
  SELECT s, c FROM sale UNION ALL
  SELECT c, p FROM sale)"""


def order_parts(spark: SparkSession, d: str) -> DataFrame:
    """Order and part of every line item; sparse."""
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))


ORDER_PARTS = """order_parts AS (
  SELECT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem)"""


def user_events(spark: SparkSession, d: str) -> DataFrame:
    """User and kind of every event; each kind holds a fifth of the rows."""
    return table(spark, d, "events").select(
        F.concat(F.lit("u"), "user_id").alias("src"), F.col("event_type").alias("dst"))


USER_EVENTS = """user_events AS (
  SELECT 'u' || user_id AS src, event_type AS dst FROM events)"""


def embedding_matrix(spark: SparkSession, d: str) -> DataFrame:
    """One row of 64 cells per embedding."""
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("index"), F.col("embedding").cast("array<double>").alias("vector"))


# Long form index, col, value; columns count from 0.
EMBEDDING_CELLS = """embedding_cells AS (
  SELECT vec_id AS index, unnest(generate_series(0, len(embedding) - 1)) AS col,
         unnest(embedding)::DOUBLE AS value FROM embeddings)"""


def trade_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Square matrix of customer nation by supplier nation: quantity sold."""
    from edgeworks.operators.matrix import from_cells

    sold = (
        table(spark, d, "lineitem")
        .join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    cells = sold.groupBy(F.col("c_nationkey").cast("bigint").alias("index"), F.col("s_nationkey").alias("col")).agg(
        F.sum("quantity").alias("value"))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("index"))
    width = nation.count()
    none = F.array_repeat(F.lit(0.0), width)
    sold_rows = from_cells(cells, width)
    return nation.join(sold_rows, "index", "left").select("index", F.coalesce("vector", none).alias("vector"))


TRADE_CELLS = """sold AS (
  SELECT c_nationkey AS index, s_nationkey AS col, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL),
trade_cells AS (
  SELECT a.n_nationkey::BIGINT AS index, b.n_nationkey::BIGINT AS col, coalesce(value, 0.0) AS value
  FROM nation a CROSS JOIN nation b
  LEFT JOIN sold ON sold.index = a.n_nationkey AND sold.col = b.n_nationkey)"""


def label_weights(spark: SparkSession, d: str) -> DataFrame:
    """Matrix of embedding cell by label: mean of the cell in the label."""
    from edgeworks.operators.matrix import from_cells

    long = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("index", "value"))
    cells = long.groupBy(F.col("index").cast("bigint").alias("index"), F.col("label").alias("col")).agg(
        F.avg(F.col("value").cast("double")).alias("value"))
    labels = table(spark, d, "embeddings").agg(F.max("label") + 1).first()[0]
    return from_cells(cells, labels)


LABEL_CELLS = """label_cells AS (
  SELECT col::BIGINT AS index, label::BIGINT AS col, avg(value) AS value
  FROM embedding_cells JOIN embeddings ON index = vec_id GROUP BY 1, 2)"""


def mean_column(spark: SparkSession, d: str) -> DataFrame:
    """Matrix of one column: the mean embedding."""
    long = table(spark, d, "embeddings").select(F.posexplode("embedding").alias("index", "value"))
    return long.groupBy(F.col("index").cast("bigint").alias("index")).agg(
        F.array(F.avg(F.col("value").cast("double"))).alias("vector"))


MEAN_CELLS = """mean_cells AS (
  SELECT col::BIGINT AS index, avg(value) AS value FROM embedding_cells GROUP BY 1)"""
