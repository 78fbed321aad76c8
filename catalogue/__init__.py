"""Registered queries over the shared tables, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name, and for those SQL can express the equivalent statement."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            name = query.__name__
            if name in self.queries:
                raise ValueError(f"query {name} registered twice")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


catalogue = Catalogue()


def load() -> Catalogue:
    """Import all modules that register queries."""
    from catalogue import central, cleaning, encoding, modelling, profiling, sampling, streams  # noqa: F401

    return catalogue
