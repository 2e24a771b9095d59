"""All registered queries of the library and their SQL counterparts, by name."""

from __future__ import annotations

from . import catalogue_queries, evaluation_queries, maintenance_queries, response_queries, search_queries, structure_queries, telemetry_queries

_PARTS = [search_queries, telemetry_queries, evaluation_queries, maintenance_queries, catalogue_queries, response_queries, structure_queries]

QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}
