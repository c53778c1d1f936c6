"""Where queries and their oracle SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voidage.sources import derived

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None) -> Callable:
    """Register ``fn(field) -> DataFrame`` as a query over the derived base tables."""

    def add(fn: Callable[[derived.Field], DataFrame]) -> Callable:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = lambda spark, sf_dir: fn(derived.Field(spark, sf_dir))
        QUERIES[key].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
