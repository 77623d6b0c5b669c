from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.standin import plain_sql, table, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Test tables and course-shaped views of one folder, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("v_"):
            return view(self.spark, self.sf_dir, name)
        return table(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name with its checking SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = plain_sql(sql)
        return fn

    return register
