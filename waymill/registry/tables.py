"""Access to the test tables, and a decorator that collects the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def collector() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """Two empty registers and the decorator ``@query(sql)`` that fills them.

    A query is registered under its function's name unless another is given.
    """
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}

    def query(sql: str, name: str | None = None):
        def register(function: Callable[[Tables], DataFrame]):
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return function(Tables(spark, folder))

            key = name or function.__name__
            run.__name__, run.__doc__ = key, function.__doc__
            queries[key], oracles[key] = run, sql
            return function

        return register

    return queries, oracles, query
