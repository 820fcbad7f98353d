"""Queries of this subpackage and, where SQL can say it, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulse.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder)`` under ``name`` with its oracle SQL."""

    def wrap(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(configure(spark), folder)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return wrap


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A whole table, or some of its columns."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
