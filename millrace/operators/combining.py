"""Bringing tables together: by rows, by columns, by key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import q


def stack_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column one frame lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def beside(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of both frames for rows with the same unique key."""
    return left.join(right, key, "inner")


def failed_groups(requested: DataFrame, obtained: DataFrame, on: str) -> DataFrame:
    """Requested groups that did not arrive."""
    return requested.join(obtained.select(q(on)).distinct(), on, "left_anti")


def compare_metrics(first: DataFrame, second: DataFrame, names: tuple[str, str] = ("validation", "test")) -> DataFrame:
    """(metric, <first>, <second>) from two (metric, value) tables."""
    a = first.select("metric", F.col("value").alias(names[0]))
    b = second.select("metric", F.col("value").alias(names[1]))
    return a.join(b, "metric", "left")


def to_long(df: DataFrame, names: Iterable[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """One row per column of a one-row (or short) wide table."""
    rows = F.array(*[F.struct(F.lit(c).alias(metric), q(c).cast("double").alias(value)) for c in names])
    return df.select(F.explode(rows).alias("r")).select(f"r.{metric}", f"r.{value}")
