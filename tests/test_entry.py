import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"

sys.path.insert(0, ROOT)

import __spark_entry__ as contract  # noqa: E402
import bench  # noqa: E402
from edgeworks.plans import ORACLES, QUERIES  # noqa: E402

# One of each family; tests/oracle_check.py runs them all.
CHECKED = [
    "degree_distribution", "find_vertices_report", "pagerank_10", "triangle_count",
    "links_above_endpoint_means", "maximal_matching_mpc", "scored_matching_global",
    "matmul_shuffle", "append_rows", "scored_links_strict", "word_count",
]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(bench.HEADLINE) <= set(contract.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_its_sql(spark, name):
    from oracle_check import compare, connect

    outcome = compare(spark, connect(SMALL), name, contract.queries()[name], contract.oracle_sql()[name], SMALL)
    assert outcome.startswith("ok"), outcome
