"""The registered queries and the SQL they are checked against."""

from edgeworks.plans import graphs, lookups, matchings, matrices, storage, tables  # noqa: F401  (fill the registry)
from edgeworks.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
