"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import wall_clock_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    """Register ``function(spark, folder)`` under a name, with the SQL for the same result."""

    def keep(function):
        def query(spark: SparkSession, folder: str) -> DataFrame:
            with wall_clock_utc(spark):
                return function(spark, folder)

        query.__name__, query.__doc__ = name, function.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep
