"""The queries of the engine over the driver's tables, each with the SQL that it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, folder) under its own name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


from siftline.plans import queries_aggregate, queries_fields, queries_flows, queries_intake, queries_joins, queries_pick, queries_scalar, queries_stages, queries_state, queries_stored  # noqa: E402, F401
