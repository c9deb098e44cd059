"""Small table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeworks.operators import balance, tables
from edgeworks.plans.inputs import table
from edgeworks.plans.registry import query


@query("word_count", """SELECT word, count(*) AS "count" FROM (
  SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def _(spark, d):
    return tables.word_count(table(spark, d, "documents"), "text")


@query("inner_join_using", """SELECT o_custkey AS id, o_orderkey, o_totalprice, c_name, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_totalprice")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment")
    return tables.join_on(orders, customers, "id")


@query("top_k", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def _(spark, d):
    return tables.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query("with_row_index", """SELECT o_orderkey, o_totalprice,
  row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_index FROM orders""")
def _(spark, d):
    return tables.with_row_index(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


# How a scan is cut depends on the cluster; the rows of all parts do not.
@query("rows_per_partition", "SELECT count(*)::BIGINT AS rows, true AS parts FROM lineitem")
def _(spark, d):
    found = tables.rows_per_partition(table(spark, d, "lineitem"))
    return found.agg(F.sum("rows").alias("rows"), (F.count(F.lit(1)) > 0).alias("parts"))


@query("is_empty", """SELECT (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0 AS none,
  (SELECT count(*) FROM orders) = 0 AS all_rows""")
def _(spark, d):
    orders = table(spark, d, "orders")
    none, every = (tables.is_empty(x) for x in (orders.filter("o_totalprice < 0"), orders))
    return orders.agg(F.lit(none).alias("none"), F.lit(every).alias("all_rows"))


# Where tasks run depends on the cluster; the rows of all machines do not.
@query("rows_per_host", "SELECT count(*)::BIGINT AS rows, true AS hosts, true AS tasks FROM lineitem")
def _(spark, d):
    found = balance.rows_per_host(table(spark, d, "lineitem"))
    return found.agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.length("host") > 0).alias("hosts"),
        (F.sum("tasks") >= F.count(F.lit(1))).alias("tasks"))
