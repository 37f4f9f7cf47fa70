"""All registered queries of the engine and their DuckDB twins."""

from __future__ import annotations

from marginalia.plans import exchange, geometry, pages, relations, review, scalars, texts

_PARTS = (texts, relations, pages, scalars, geometry, review, exchange)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
FLAGSHIP = "review_queue"
