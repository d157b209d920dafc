"""Collects queries and their SQL under one name."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from moonstride.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """Scans of one folder's tables: ``tables.orders`` and so on."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self._folder, name)


def query(sql: str) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register ``function(tables)`` under its own name."""

    def add(function: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        _QUERIES[function.__name__] = run
        _SQL[function.__name__] = dedent(sql).strip()
        return run

    return add


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_SQL)
