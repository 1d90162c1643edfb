"""Queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from foliospark.plans import alignment_queries, audit_queries, corpus_queries, line_queries, stat_queries, text_queries

_MODULES = [line_queries, alignment_queries, stat_queries, text_queries, corpus_queries, audit_queries]
QUERIES: dict = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict = {k: v for m in _MODULES for k, v in m.SQL.items()}
