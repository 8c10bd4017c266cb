"""Registered queries: a Spark callable and, where SQL can say it, the same query for a SQL engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, Callable[[], str]] = {}


def query(name: str, sql: Callable[[], str] | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
