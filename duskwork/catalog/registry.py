"""Queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from duskwork.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Pinned "as of" moments: just after the last order, just after the last event.
AFTER_ORDERS = datetime(2001, 8, 2)
AFTER_EVENTS = datetime(2024, 1, 31)


class Source:
    """The given tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = read_table(self.spark, self._folder, name)
        return self._read[name]


def query(sql: str | None = None, name: str | None = None):
    """Register ``function(source)`` under its own name (or ``name``)."""

    def register(function: Callable[[Source], DataFrame]):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Source(spark, folder))

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql.strip()
        return function

    return register
