"""Registry of the engine's named queries and their SQL. Each reads whole tables of a directory and gives a DataFrame."""

from __future__ import annotations

from . import census_queries, entity_queries, graph_queries, relation_queries, source_queries, text_queries

_MODULES = (relation_queries, entity_queries, text_queries, census_queries, graph_queries, source_queries)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
