"""Registry of the queries over the driver's tables: name to query, and name to DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        from attestor.sources.tables import parquet

        return parquet(self.spark, self.folder, name)


def query(sql: str | None = None):
    """Registers a function of Tables under its own name, with its oracle."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


from attestor.plans import evidence_queries, more_queries, order_queries, record_queries, report_queries, resolution_queries, rule_queries, scalar_queries  # noqa: E402, F401
