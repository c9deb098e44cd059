"""Run queries and their SQL on one set of tables and compare the rows.

    python tests/oracle_check.py DIR [NAME ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, query, sql: str | None, d: str) -> str:
    started = time.time()
    df = query(spark, d)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    if sql is None:
        return f"rows only ({len(got)}) {took:.2f}s"
    started = time.time()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    want = rows_of(columns, result.fetchall())
    sql_took = time.time() - started
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {df.columns} {columns}"
    for column, kind in df.dtypes:
        if kind != TYPES.get(kinds[column], kinds[column]):
            return f"FAIL column {column}: {kind}, SQL {kinds[column]}"
    if len(got) != len(want):
        return f"FAIL {len(got)} rows, SQL {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"FAIL {a} {b}"
    return f"ok ({len(got)}) {took:.2f}s, SQL {sql_took:.2f}s"


def main() -> None:
    from pyspark.sql import SparkSession

    from edgeworks.plans import ORACLES, QUERIES

    d, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("CHECK_PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(d), []
    for name in names:
        try:
            outcome = compare(spark, con, name, QUERIES[name], ORACLES.get(name), d)
        except Exception as error:  # report and go on with the others
            outcome = f"FAIL {type(error).__name__}: {str(error)[:600]}"
        if outcome.startswith("FAIL"):
            bad.append(name)
        print(f"{name}: {outcome}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failed: {bad}")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
