"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is ``fn(spark, sf_dir) -> DataFrame``; ``sql`` (optional) is the
same result written as DuckDB SQL over the input tables, used as the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco
