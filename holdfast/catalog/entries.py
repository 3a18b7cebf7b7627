"""The table of registered queries: a Spark callable per key and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def entry(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with the SQL that gives the same rows."""

    def add(query: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key!r} registered twice")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add
