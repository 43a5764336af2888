"""Registered queries over the test tables, each with its SQL statement.

``QUERIES`` maps a name to a function of (session, table folder); ``SQL`` maps
it to the statement that must give the same rows.
"""

from rinkflow.plans.catalog.registry import QUERIES, SQL
from rinkflow.plans.catalog import bundles, joined, rows, sequences, sourced, statistics  # noqa: F401

__all__ = ["QUERIES", "SQL"]
