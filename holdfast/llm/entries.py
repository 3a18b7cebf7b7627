"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def entry(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with its SQL where SQL can state it."""

    def add(query: Query) -> Query:
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
