"""Request rates, latency histograms and outcome summaries.

Every function takes a batch or a streaming table: the expressions are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import q
from millrace.operators.ranking import grouped_quantile

# Upper bounds of the default latency buckets, in seconds.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
WATERMARK = "1 hour"
# No longer used: quantiles of all statuses share two passes. Kept for callers that set it.
STATUSES_PER_PASS = 32


def with_event_time(df: DataFrame, column: str, watermark: str = WATERMARK) -> DataFrame:
    """The time as a timestamp; on a stream rows later than the watermark are dropped."""
    timed = df.withColumn(column, q(column).cast("timestamp"))
    return timed.withWatermark(column, watermark) if df.isStreaming else timed


def request_rate(df: DataFrame, ts: str, by: Sequence[str] = (), seconds: int = 10) -> DataFrame:
    """(window_start, .., n_requests, rate) per tumbling interval with requests."""
    n = F.count(F.lit(1))
    return (
        with_event_time(df, ts)
        .groupBy(F.window(q(ts), f"{seconds} seconds").alias("w"), *[q(c) for c in by])
        .agg(n.alias("n_requests"), (n / F.lit(float(seconds))).alias("rate"))
        .select(F.col("w.start").alias("window_start"), *by, "n_requests", "rate")
    )


def bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Cumulative counts: values at or below each bound; the last bucket (+Inf) holds all."""
    cells = [F.count(F.when(value <= F.lit(float(b)), 1)).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return [*cells, F.count(value).alias(f"le_{len(bounds)}")]


def latency_histogram(
    df: DataFrame, value: str, ts: str | None = None, seconds: int = 10, by: Sequence[str] = (),
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """One row per window (and group): le_0 .. le_n cumulative, total, n_values.

    With `ts` None the whole table is one histogram per group.
    """
    aggs = [*bucket_counts(q(value), bounds), F.sum(q(value)).alias("total"), F.count(q(value)).alias("n_values")]
    if ts is None:
        return df.groupBy(*[q(c) for c in by]).agg(*aggs)
    out = (
        with_event_time(df, ts)
        .groupBy(F.window(q(ts), f"{seconds} seconds").alias("w"), *[q(c) for c in by])
        .agg(*aggs)
    )
    names = [c for c in out.columns if c != "w"]
    return out.select(F.col("w.start").alias("window_start"), *names)


def histogram_long(wide: DataFrame, keys: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """(keys, le, n): one row per bucket, the last one named +Inf."""
    names = [*[f"{float(b):g}" for b in bounds], "+Inf"]
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("le"), F.col(f"le_{i}").alias("n")) for i, name in enumerate(names)
    ]))
    return wide.select(*[q(c) for c in keys], cells.alias("b")).select(*keys, "b.le", "b.n")


def outcome_summary(df: DataFrame, status: str, duration: str) -> DataFrame:
    """(status, n, mean_duration, max_duration, p95_duration) of load results, a batch table.

    The 95th percentile is exact, for any number of statuses.
    """
    summary = df.groupBy(q(status).alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(q(duration)).alias("mean_duration"), F.max(q(duration)).alias("max_duration")
    )
    p95 = grouped_quantile(df, status, duration, 0.95).withColumnsRenamed({"group": "_group", "quantile": "p95_duration"})
    return summary.join(p95, F.col("status").eqNullSafe(F.col("_group")), "left").drop("_group")
