"""Small inputs with known answers."""

from __future__ import annotations

import random

#: Shuffle partitions of the test session.
PARTS = 2

# One edge twice; 4 is a sink.
TINY = [(1, 2), (1, 3), (2, 3), (3, 4), (1, 2)]


def edges(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"src {kind}, dst {kind}")


def links(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, score double")


def random_rows(seed, vertices=30, count=90, hub=True):
    """Copies, both directions, self-loops, and a hub with a third of the rows."""
    rng = random.Random(seed)
    rows = [(rng.randrange(vertices), rng.randrange(vertices)) for _ in range(count)]
    if hub:
        rows += [(0, rng.randrange(vertices)) if i % 2 else (rng.randrange(vertices), 0) for i in range(count // 2)]
    return rows


def undirected(rows):
    return sorted({(min(a, b), max(a, b)) for a, b in rows if a != b})


def table(df):
    return sorted(tuple(row) for row in df.collect())
