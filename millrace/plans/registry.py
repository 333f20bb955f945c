"""All queries of the core, and their SQL."""

from __future__ import annotations

from millrace.plans import crm_queries, function_queries, io_queries, log_queries, ml_queries, problems, sampling_queries, text_queries

_MODULES = [problems, crm_queries, log_queries, text_queries, ml_queries, sampling_queries, function_queries, io_queries]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
