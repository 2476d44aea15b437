"""All registered queries with their SQL twins."""

from __future__ import annotations

from panelprep.plans import join_queries, page_queries, quality_queries, scan_queries, window_queries

_MODULES = (scan_queries, join_queries, quality_queries, window_queries, page_queries)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
