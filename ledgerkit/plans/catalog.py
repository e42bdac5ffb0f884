"""The registry of queries and their oracle SQL (one key per operator group)."""
from __future__ import annotations

from . import oracle, queries

QUERIES = dict(queries.QUERIES)
ORACLE_SQL = {k: v for k, v in oracle.ORACLE.items() if k in QUERIES}
