"""Collects queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register f(tables) -> DataFrame under its name, with its SQL."""

    def add(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are called {key}")
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add
