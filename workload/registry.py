"""Name -> query function and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name, with the SQL it must agree with."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise KeyError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return add
