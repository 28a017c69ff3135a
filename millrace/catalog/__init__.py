"""Registered queries with the SQL that must give the same rows.

Every query takes (spark, sf_dir) and reads whole tables. `collect_catalog` imports
the modules of this package and returns the two dictionaries.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = (
    "source_queries", "cleaning_queries", "joining_queries", "encoding_queries", "selecting_queries",
    "profiling_queries", "sampling_queries", "validating_queries", "model_queries", "stream_queries",
)


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with its SQL where SQL can express it."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def collect_catalog() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for module in MODULES:
        import_module(f"millrace.catalog.{module}")
    return dict(QUERIES), dict(ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(col: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; a negative zero becomes zero."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits) + F.lit(0.0)


# ------------------------------------------------------------------ SQL parts


def hash_order(seed: int | str, key: str, alias: str = "") -> str:
    k = f"{alias}.{key}" if alias else key
    return f"md5(concat_ws(':', '{seed}', {k})), {k}"


def stratified_cte(name: str, source: str, key: str, label: str, num: int, den: int, seed: int | str) -> str:
    """CTEs ending in `name`: all columns of `source` and `is_test` for the share num/den."""
    return f"""
    {name}_cls AS (SELECT {label} AS g, count(*) AS c FROM {source} GROUP BY 1),
    {name}_tot AS (SELECT CAST(sum(c) AS BIGINT) AS n,
        CAST((sum(c) * {num} + {den} - 1) // {den} AS BIGINT) AS t FROM {name}_cls),
    {name}_part AS (SELECT g, (c * t) // n AS w, t,
        row_number() OVER (ORDER BY (c * t) % n DESC, g) AS rk FROM {name}_cls, {name}_tot),
    {name}_quota AS (SELECT g, w + CASE WHEN rk <= t - (SELECT sum(w) FROM {name}_part) THEN 1 ELSE 0 END AS quota
        FROM {name}_part),
    {name} AS (SELECT s.*, row_number() OVER (PARTITION BY s.{label} ORDER BY {hash_order(seed, key, 's')})
        <= q.quota AS is_test FROM {source} s JOIN {name}_quota q ON s.{label} = q.g)"""


# `readmitted` of the encounter flow: orders with status F or P count as YES.
ORDER_LABEL = "CASE WHEN o_orderstatus IN ('F', 'P') THEN 'YES' ELSE 'NO' END"


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.functions.cleaning import binary_label

    return table(spark, sf_dir, "orders").withColumn("target", binary_label(F.col("o_orderstatus"), ("F", "P")))


LABELLED = f"labelled AS (SELECT *, {ORDER_LABEL} AS target FROM orders)"
THREE_WAY = (
    LABELLED + ","
    + stratified_cte("s1", "labelled", "o_orderkey", "target", 1, 5, 42) + ","
    + "rest AS (SELECT * EXCLUDE (is_test) FROM s1 WHERE NOT is_test),"
    + stratified_cte("s2", "rest", "o_orderkey", "target", 1, 4, 43) + ","
    + """
    parts AS (SELECT * EXCLUDE (is_test), 'test' AS split FROM s1 WHERE is_test
        UNION ALL SELECT * EXCLUDE (is_test), CASE WHEN is_test THEN 'validation' ELSE 'train' END FROM s2)"""
)
