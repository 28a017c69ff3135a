"""The queries of this package and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("text_queries", "vector_queries", "page_queries", "search_queries", "language_queries")


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with its SQL where SQL can express it."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for module in _MODULES:
        import_module(f"millrace.llm.{module}")
    return dict(QUERIES), dict(ORACLES)
