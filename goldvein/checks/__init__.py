"""Queries on the given tables, each with the SQL that must give the same rows.

Importing this package fills ``QUERIES`` and ``ORACLE_SQL``.
"""

from goldvein.checks.registry import ORACLE_SQL, QUERIES
from goldvein.checks import cleaning, commerce, dedup, history, kpis, reports, storage, upsert  # noqa: F401

__all__ = ["ORACLE_SQL", "QUERIES"]
