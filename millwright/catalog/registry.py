"""The registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millwright.catalog.bind import Tables, plain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its SQL when there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register
