"""All registered queries and their SQL oracles."""

from __future__ import annotations

from . import lake_queries, model_queries, scoring_queries, settlement_queries

_GROUPS = [settlement_queries, lake_queries, model_queries, scoring_queries]

QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLE = {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
