"""Register of the runnable queries and, where SQL can say the same, of their check texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from matchlake.plans.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL it must agree with."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            CHECK_SQL[name] = sql.strip()
        return build

    return register
