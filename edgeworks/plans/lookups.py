"""Lookups in a stored graph: whole link tables are stored, then few files are read."""

from __future__ import annotations

from edgeworks.loop import Workspace
from edgeworks.operators.store import EdgeStore
from edgeworks.plans.inputs import PART_LINKS, part_links
from edgeworks.plans.registry import query


def _store(spark, d) -> EdgeStore:
    return EdgeStore.write(part_links(spark, d), Workspace(spark).path("graph"))


def _message(vertex: str) -> str:
    return f"""WITH {PART_LINKS} SELECT 'User ID {vertex}' || CASE WHEN count(*) > 0 THEN ' found' ELSE ' not found' END
  || ' in the dataset.' AS message FROM part_links WHERE src = '{vertex}' OR dst = '{vertex}'"""


@query("stored_edges", f"WITH {PART_LINKS} SELECT src, dst, score FROM part_links")
def _(spark, d):
    return _store(spark, d).edges()


@query("stored_incident_edges", f"WITH {PART_LINKS} SELECT src, dst, score FROM part_links WHERE src = 's3' OR dst = 's3'")
def _(spark, d):
    return _store(spark, d).incident_edges("s3")


@query("stored_incident_count", f"WITH {PART_LINKS} SELECT count(*) AS edges FROM part_links WHERE src = 'p7' OR dst = 'p7'")
def _(spark, d):
    return _store(spark, d).incident_count("p7")


@query("stored_neighbor_ids", f"""WITH {PART_LINKS} SELECT CASE WHEN src = 's3' THEN dst ELSE src END AS id
  FROM part_links WHERE src = 's3' OR dst = 's3'""")
def _(spark, d):
    return _store(spark, d).neighbor_ids("s3")


@query("stored_find_report", _message("p7"))
def _(spark, d):
    return _store(spark, d).find_vertex_report("p7")


@query("stored_find_missing", _message("1691593"))
def _(spark, d):
    return _store(spark, d).find_vertex_report("1691593")
