"""Queries of the operators for training data, and the SQL of those that SQL can express."""

from __future__ import annotations

from millrace.llm import queries_articles as articles, queries_tables as tables, queries_texts as texts

_MODULES = [tables, articles, texts]

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
