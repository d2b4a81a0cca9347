"""Registry of named queries and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables.
The oracle is an independent SQL formulation (DuckDB dialect) over the same
tables, used to check values; queries without an SQL form register none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the plan modules fills the registry.
    from marketpulse.plans import market, monitor, ops, social, streams  # noqa: F401
