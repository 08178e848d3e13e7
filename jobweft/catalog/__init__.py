"""Registered queries: every operator on the given tables, with equivalent SQL.

A query is ``(spark, sf_dir) -> DataFrame`` over whole tables. The SQL beside it is
written for another engine and shares no code with the query.
"""

from __future__ import annotations

from jobweft.catalog import adapters, extraction, linking, loads, matching, reports, runs, validation

MODULES = [reports, matching, extraction, adapters, validation, runs, linking, loads]


def registered() -> dict:
    return {name: query for module in MODULES for name, (query, _) in module.QUERIES.items()}


def equivalent_sql() -> dict:
    return {
        name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None
    }
