"""Readers, writers and generators.

Each query writes a whole table in one of the file formats, into the shared
folder of the cluster, and reads it back with the reader under test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks import sources
from edgeworks.functions import found_message
from edgeworks.loop import Workspace
from edgeworks.operators.graph import incident_edges
from edgeworks.operators.matrix import cells
from edgeworks.plans import rounds
from edgeworks.plans.inputs import EMBEDDING_CELLS, PART_LINKS, embedding_matrix, part_links, table
from edgeworks.plans.registry import query

P, S = "l_partkey", "l_suppkey"


def _lines(spark, d: str, line: Column) -> str:
    """Path of a text file with one line per line item."""
    path = Workspace(spark).path("lines")
    sources.write_lines(table(spark, d, "lineitem").select(line.alias("value")), path)
    return path


def _plain(sep: str) -> Column:
    return F.concat_ws(sep, P, S)


@query("read_lines", "SELECT l_partkey || ' ' || l_suppkey AS value FROM lineitem")
def _(spark, d):
    return sources.read_lines(spark, _lines(spark, d, _plain(" ")))


@query("count_rows", "SELECT count(*) AS rows FROM lineitem")
def _(spark, d):
    return sources.count_rows(spark, _lines(spark, d, _plain(" ")))


TEXT_ENDS = "SELECT l_partkey::VARCHAR AS src, l_suppkey::VARCHAR AS dst FROM lineitem"


@query("edge_list_space", TEXT_ENDS)
def _(spark, d):
    return sources.read_edge_list(spark, _lines(spark, d, _plain(" ")))


@query("edge_list_tab", TEXT_ENDS)
def _(spark, d):
    return sources.read_edge_list(spark, _lines(spark, d, _plain("\t")), sep="\t")


@query("edge_list_bad_lines", TEXT_ENDS + " WHERE l_linenumber NOT IN (1, 2, 3)")
def _(spark, d):
    number = F.col("l_linenumber")
    line = (
        F.when(number == 1, F.col(P).cast("string"))
        .when(number == 2, F.concat(_plain(" "), F.lit(" x")))
        .when(number == 3, F.lit(""))
        .otherwise(_plain(" "))
    )
    return sources.read_edge_list(spark, _lines(spark, d, line))


@query("edge_list_int", "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem")
def _(spark, d):
    line = F.concat(F.lit("  "), P, F.lit(" \t "), S, F.lit(" "))
    return sources.read_edge_list(spark, _lines(spark, d, line), sep=r"\s+", id_type="bigint", on_bad="fail")


@query("edge_list_attr", "SELECT l_partkey AS src, l_suppkey AS dst, 1 AS attr FROM lineitem")
def _(spark, d):
    path = _lines(spark, d, _plain(" "))
    return sources.read_edge_list(spark, path, sep=r"\s+", id_type="bigint", on_bad="fail", attr=1)


@query("edge_list_named", 'SELECT l_partkey AS "Vertex1", l_suppkey AS "Vertex2" FROM lineitem')
def _(spark, d):
    path = _lines(spark, d, _plain(" "))
    return sources.read_edge_list(spark, path, sep=r"\s+", id_type="bigint", names=("Vertex1", "Vertex2"))


def _link_file(spark, d: str, score: Column) -> str:
    """Path of a link file with its header, one row per line item."""
    path = Workspace(spark).path("links")
    rows = table(spark, d, "lineitem").select(
        F.concat(F.lit("p"), P).alias("protein1"), F.concat(F.lit("s"), S).alias("protein2"),
        score.alias("combined_score"))
    rows.write.option("sep", " ").option("header", True).option("quote", "\u0000").csv(path)
    return path


def _whole() -> Column:
    return F.col("l_quantity").cast("int").cast("string")


LINKS = "SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst, l_quantity::INT AS score FROM lineitem"


@query("scored_links_csv", LINKS)
def _(spark, d):
    return sources.read_scored_links(spark, _link_file(spark, d, _whole()))


@query("scored_links_float", LINKS.replace("::INT", ""))
def _(spark, d):
    return sources.read_scored_links(spark, _link_file(spark, d, F.col("l_quantity").cast("string")), score_type="double")


@query("links_unscored", "SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem")
def _(spark, d):
    return sources.read_scored_links(spark, _link_file(spark, d, _whole())).select("src", "dst")


@query("scored_links_strict", LINKS + " WHERE l_linenumber NOT IN (1, 2)")
def _(spark, d):
    number = F.col("l_linenumber")
    score = F.when(number == 1, F.lit("many")).when(number == 2, F.concat(_whole(), F.lit(" 9"))).otherwise(_whole())
    return sources.read_scored_links(spark, _link_file(spark, d, score), on_bad="drop")


@query("scored_links_blanks", LINKS + " WHERE l_linenumber <> 5")
def _(spark, d):
    # Tabs, runs of blanks, blanks at the ends, and every fifth line of an order has a field too many.
    number, p, s = F.col("l_linenumber"), F.concat(F.lit("p"), P), F.concat(F.lit("s"), S)
    line = (
        F.when(number == 1, F.concat_ws("\t", p, s, _whole()))
        .when(number == 2, F.concat(p, F.lit("   "), s, F.lit(" \t "), _whole()))
        .when(number == 3, F.concat(F.lit("  "), F.concat_ws(" ", p, s, _whole()), F.lit(" ")))
        .when(number == 5, F.concat_ws(" ", p, s, _whole(), F.lit("x")))
        .otherwise(F.concat_ws(" ", p, s, _whole())))
    path = Workspace(spark).path("links")
    table(spark, d, "lineitem").select(line.alias("value")).write.text(path)
    return sources.read_scored_links(spark, path, on_bad="drop", header="protein1 protein2 combined_score")


@query("scored_links_min", LINKS + " WHERE l_quantity >= 20")
def _(spark, d):
    return sources.read_scored_links(spark, _link_file(spark, d, _whole()), min_score=20)


@query("delimited_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, d):
    path = Workspace(spark).path("table")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.write.option("sep", " ").option("header", True).csv(path)
    return sources.read_table(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string")


def _mtx(spark, d: str) -> str:
    # Some rows carry the comment and size lines such a file starts with.
    number = F.col("l_linenumber")
    line = (
        F.when(number == 1, F.concat(F.lit("% "), _plain(" ")))
        .when(number == 2, F.concat(_plain(" "), F.lit(" 5")))
        .otherwise(_plain(" "))
    )
    return _lines(spark, d, line)


MTX = "FROM lineitem WHERE l_linenumber NOT IN (1, 2)"


@query("mtx_edges", f"""SELECT DISTINCT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst
  {MTX} AND l_partkey <> l_suppkey""")
def _(spark, d):
    return sources.read_mtx_edges(spark, _mtx(spark, d))


@query("mtx_edges_upper", f"SELECT l_partkey AS src, l_suppkey AS dst {MTX} AND l_partkey < l_suppkey")
def _(spark, d):
    return sources.read_mtx_edges(spark, _mtx(spark, d), orientation="upper")


# ---- rejected lines set aside


def _flawed_edges(spark, d):
    number = F.col("l_linenumber")
    line = (
        F.when(number == 1, F.col(P).cast("string"))
        .when(number == 2, F.concat(_plain(" "), F.lit(" x")))
        .when(number == 3, F.concat_ws(" ", P, F.lit("x")))
        .when(number == 4, F.concat_ws(" ", F.lit("x"), S))
        .otherwise(_plain(" ")))
    return sources.quarantine_edges(spark, _lines(spark, d, line), Workspace(spark).path("split"), id_type="bigint")


@query("quarantine_good", "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_linenumber > 4")
def _(spark, d):
    return _flawed_edges(spark, d)[0]


@query("quarantine_bad", """SELECT reason, count(*) AS lines, count(*) AS with_file, sum(length(line))::BIGINT AS chars FROM (
  SELECT CASE l_linenumber WHEN 1 THEN '1 fields, not 2' WHEN 2 THEN '3 fields, not 2'
      WHEN 3 THEN 'dst is no bigint' ELSE 'src is no bigint' END AS reason,
    CASE l_linenumber WHEN 1 THEN l_partkey::VARCHAR WHEN 2 THEN l_partkey || ' ' || l_suppkey || ' x'
      WHEN 3 THEN l_partkey || ' x' ELSE 'x ' || l_suppkey END AS line
  FROM lineitem WHERE l_linenumber <= 4) GROUP BY reason""")
def _(spark, d):
    bad = _flawed_edges(spark, d)[1]
    return bad.groupBy("reason").agg(
        F.count(F.lit(1)).alias("lines"), F.count("file").alias("with_file"), F.sum(F.length("line")).alias("chars"))


@query("quarantine_links_bad", """SELECT 'p' || l_partkey || ' s' || l_suppkey || ' many' AS line, 'score is no int' AS reason
  FROM lineitem WHERE l_linenumber = 1 UNION ALL
  SELECT 'p' || l_partkey || ' s' || l_suppkey || ' ' || l_quantity::INT || ' 9', '4 fields, not 3'
  FROM lineitem WHERE l_linenumber = 2""")
def _(spark, d):
    number = F.col("l_linenumber")
    score = F.when(number == 1, F.lit("many")).when(number == 2, F.concat(_whole(), F.lit(" 9"))).otherwise(_whole())
    path = _lines(spark, d, F.concat(F.lit("p"), P, F.lit(" s"), S, F.lit(" "), score))
    bad = sources.quarantine_links(spark, path, Workspace(spark).path("split"))[1]
    return bad.select("line", "reason")


# ---- sinks


@query("report_text_sink", f"""WITH {PART_LINKS} SELECT 'User ID p7' ||
  CASE WHEN count(*) > 0 THEN ' found' ELSE ' not found' END || ' in the dataset.' AS value
  FROM part_links WHERE src = 'p7' OR dst = 'p7'""")
def _(spark, d):
    path = Workspace(spark).path("report")
    found = incident_edges(part_links(spark, d), "p7").agg((F.count(F.lit(1)) > 0).alias("found"))
    sources.write_lines(found.select(found_message(F.lit("p7"), F.col("found")).alias("value")), path)
    return sources.read_lines(spark, path)


@query("edges_text_comma", "SELECT 'p' || l_partkey || ',s' || l_suppkey AS value FROM lineitem")
def _(spark, d):
    path = Workspace(spark).path("edges")
    sources.write_edges(part_links(spark, d), path)
    return sources.read_lines(spark, path)


@query("edges_text_space", "SELECT 'p' || l_partkey || ' s' || l_suppkey AS value FROM lineitem")
def _(spark, d):
    path = Workspace(spark).path("edges")
    sources.write_edges(part_links(spark, d), path, sep=" ")
    return sources.read_lines(spark, path)


@query("gzip_text_sink", """SELECT 'p' || l_partkey || ' s' || l_suppkey AS value, true AS packed FROM lineitem""")
def _(spark, d):
    path = Workspace(spark).path("edges")
    sources.write_edges(part_links(spark, d), path, sep=" ", compression="gzip")
    packed = F.col("_metadata.file_name").endswith(".gz")
    return sources.read_lines(spark, path).select("value", packed.alias("packed"))


@query("output_files", "SELECT 6::BIGINT AS files, count(*) AS rows FROM lineitem")
def _(spark, d):
    path = Workspace(spark).path("edges")
    sources.write_edges(part_links(spark, d), path, files=6)
    per_file = sources.read_lines(spark, path).groupBy("_metadata.file_name").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


@query("overwrite_text_sink", "SELECT 'p' || l_partkey || ' s' || l_suppkey AS value FROM lineitem")
def _(spark, d):
    path = Workspace(spark).path("edges")
    sources.write_edges(part_links(spark, d), path)
    sources.write_edges(part_links(spark, d), path, sep=" ", mode="overwrite")
    return sources.read_lines(spark, path)


@query("neighbors_csv", f"WITH {PART_LINKS} SELECT src, dst, score FROM part_links WHERE src = 's3' OR dst = 's3'")
def _(spark, d):
    path = Workspace(spark).path("neighbors")
    sources.write_csv(incident_edges(part_links(spark, d), "s3"), path)
    return spark.read.schema("src string, dst string, score double").csv(path)


@query("edges_csv_header", 'SELECT l_partkey AS "Vertex1", l_suppkey AS "Vertex2" FROM lineitem')
def _(spark, d):
    path = Workspace(spark).path("edges")
    edges = table(spark, d, "lineitem").select(F.col(P).alias("Vertex1"), F.col(S).alias("Vertex2"))
    sources.write_csv(edges, path, header=True)
    return sources.read_table(spark, path, "Vertex1 bigint, Vertex2 bigint", sep=",")


# ---- stored matrices

STORED = f"WITH {EMBEDDING_CELLS} SELECT index, col, round(value, 6) AS value FROM embedding_cells"


def _rounded(m: DataFrame) -> DataFrame:
    return cells(m).select("index", "col", F.round("value", 6).alias("value"))


@query("matrix_csv_roundtrip", STORED)
def _(spark, d):
    path = Workspace(spark).path("matrix")
    sources.write_matrix_csv(embedding_matrix(spark, d), path)
    return _rounded(sources.read_matrix_csv(spark, path))


@query("matrix_parquet_roundtrip", STORED)
def _(spark, d):
    path = Workspace(spark).path("matrix")
    sources.write_parquet(embedding_matrix(spark, d), path)
    return _rounded(sources.read_matrix_parquet(spark, path))


@query("append_rows", f"""WITH {EMBEDDING_CELLS} SELECT index, col, round(value, 6) AS value FROM (
  SELECT index, col, value FROM embedding_cells UNION ALL
  SELECT index + (SELECT max(vec_id) + 1 FROM embeddings), col, value FROM embedding_cells)""")
def _(spark, d):
    path = Workspace(spark).path("matrix")
    sources.write_matrix_csv(embedding_matrix(spark, d), path)
    return _rounded(sources.append_rows(spark, path, embedding_matrix(spark, d)))


# Three appends, of which one is lost before its commit.
LOGGED = f"""WITH {EMBEDDING_CELLS}, grown AS (
  SELECT index, col, value FROM embedding_cells UNION ALL
  SELECT index + (SELECT max(vec_id) + 1 FROM embeddings), col, value FROM embedding_cells)"""


def _logged(spark, d: str) -> sources.MatrixLog:
    log = sources.MatrixLog(spark, Workspace(spark).path("matrix"))
    log.append(embedding_matrix(spark, d))
    log.stage(embedding_matrix(spark, d))
    log.append(embedding_matrix(spark, d))
    return log


@query("append_logged", f"{LOGGED} SELECT index, col, round(value, 6) AS value FROM grown")
def _(spark, d):
    return _rounded(_logged(spark, d).read())


@query("append_log", """SELECT "first", "first" + n AS "next", total AS rows, width AS cols FROM (
  SELECT max(vec_id) + 1 AS n, count(*) AS total, max(len(embedding)) AS width FROM embeddings),
  LATERAL (SELECT unnest([0, n]) AS "first")""")
def _(spark, d):
    return _logged(spark, d).log().select("first", "next", "rows", "cols")


@query("table_shape", "SELECT count(*) AS rows, max(len(embedding)) AS cols FROM embeddings")
def _(spark, d):
    path = Workspace(spark).path("matrix")
    sources.write_matrix_csv(embedding_matrix(spark, d), path)
    return sources.table_shape(spark, path)


# ---- generators, a row for each row of a table, drawn from its key


@query("random_edges", f"""SELECT ({rounds.hash60('0-src', 'id')} % 1000000 + 1)::VARCHAR AS src,
  ({rounds.hash60('0-dst', 'id')} % 1000000 + 1)::VARCHAR AS dst
  FROM (SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem)""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return sources.edges_for(rows, "id")


GRID = """(SELECT o_orderkey AS index, unnest(generate_series(0, 15)) AS col FROM orders)"""


@query("random_matrix", f"SELECT index, col, round({rounds.uniform(0, 'index', 'col')}, 9) AS value FROM {GRID}")
def _(spark, d):
    made = sources.matrix_for(table(spark, d, "orders"), "o_orderkey", 16)
    return cells(made).select("index", "col", F.round("value", 9).alias("value"))


@query("random_int_matrix", f"""SELECT index, col, floor({rounds.uniform(0, 'index', 'col')} * 100)::BIGINT AS value
  FROM {GRID}""")
def _(spark, d):
    return cells(sources.matrix_for(table(spark, d, "orders"), "o_orderkey", 16, scale=100))


# ---- empty results


@query("skip_empty_write", """SELECT (SELECT count(*) FROM lineitem WHERE l_quantity > 25) AS written,
  (SELECT count(*) FROM lineitem WHERE l_quantity < 0) = 0 AS skipped""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", F.concat_ws(" ", P, S).alias("value"))
    work = Workspace(spark)
    full, none = work.path("full"), work.path("none")
    sources.write_lines(rows.filter("l_quantity > 25").select("value"), full, skip_empty=True)
    kept = sources.write_lines(rows.filter("l_quantity < 0").select("value"), none, skip_empty=True)
    return sources.count_rows(spark, full).select(F.col("rows").alias("written"), F.lit(not kept).alias("skipped"))
