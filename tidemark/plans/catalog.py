"""The list of named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` as the query ``name``."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return add
