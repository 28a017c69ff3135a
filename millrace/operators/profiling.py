"""Profiles of tables: describe, correlation, value counts, feature statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import is_missing, is_numeric, q
from millrace.operators.encoding import value_counts_long
from millrace.operators.ranking import grouped_quantile, quantiles_beside
from millrace.session import materialise


def _clean(df: DataFrame, name: str):
    x = q(name).cast("double")
    return F.when(~F.isnan(x), x)


def _long(df: DataFrame, rows: Sequence[dict], schema: str) -> DataFrame:
    names = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
    return df.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def describe(df: DataFrame, names: Sequence[str], approximate: int | None = None) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, min, quartiles, max.

    Quartiles interpolate linearly and are exact; with `approximate` (an accuracy)
    one aggregate answers everything.
    """
    aggs = []
    for i, c in enumerate(names):
        x = _clean(df, c)
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
        if approximate:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], approximate).alias(f"q{i}"))
    if approximate:
        row = df.agg(*aggs).first()
        quartiles = {c: row[f"q{i}"] or [None] * 3 for i, c in enumerate(names)}
    else:
        quartiles, row = quantiles_beside(df, names, [0.25, 0.5, 0.75], aggs)
    rows = []
    for i, c in enumerate(names):
        p25, p50, p75 = quartiles[c]
        rows.append({
            "column": c, "count": row[f"n{i}"], "mean": row[f"m{i}"], "std": row[f"s{i}"],
            "min": row[f"l{i}"], "p25": p25, "p50": p50, "p75": p75, "max": row[f"h{i}"],
        })
    return _long(
        df, rows,
        "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double",
    )


def correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(a, b, r): Pearson correlation of every ordered pair, rows with a missing side left out.

    The number of pairs depends on the columns named, all are one aggregate.
    """
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    cols = [_clean(df, c) for c in names]
    wide = df.agg(*[F.corr(cols[i], cols[j]).alias(f"r{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            cells.append(F.struct(
                F.lit(names[a]).alias("a"), F.lit(names[b]).alias("b"), F.col(f"r{i}_{j}").alias("r")
            ))
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.a", "c.b", "c.r")


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one grouped count, missing left out."""
    return value_counts_long(df, names)


def dominant_share(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, share): part of the non-missing rows holding the most frequent value."""
    return value_counts_long(df, names).groupBy("column").agg((F.max("n") / F.sum("n")).alias("share"))


def drop_dominated(df: DataFrame, names: Sequence[str], threshold: float = 0.99) -> DataFrame:
    """Drop the named columns in which one value holds more than `threshold`."""
    over = [r["column"] for r in dominant_share(df, names).filter(F.col("share") > threshold).collect()]
    return df.drop(*over)


def class_distribution(df: DataFrame, label: str, out: str = "n") -> DataFrame:
    return df.groupBy(q(label)).agg(F.count(F.lit(1)).alias(out))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-missing rows, rows and columns of the table."""
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(~is_missing(df, c), F.lit(1))).alias(f"k{i}") for i, c in enumerate(names)],
    )
    cells = [
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"), F.col(f"k{i}").alias("non_null"),
        )
        for i, c in enumerate(names)
    ]
    return wide.select("n_rows", F.explode(F.array(*cells)).alias("c")).select(
        "c.*", "n_rows", F.lit(len(names)).alias("n_columns")
    )


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First rows in key order."""
    return df.orderBy(q(key)).limit(n)


def dataset_info(df: DataFrame, split: str, page_size: int) -> DataFrame:
    """(split, n_rows, n_pages) per split."""
    return df.groupBy(q(split)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.ceil(F.count(F.lit(1)) / F.lit(page_size)).cast("bigint").alias("n_pages"),
    )


STATS_SCHEMA = (
    "feature string, type string, n_rows bigint, n_missing bigint, mean double, std double, zeros bigint, "
    "min double, median double, max double, n_unique bigint, top string, top_freq bigint, avg_length double"
)


def feature_stats(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Statistics of every feature: moments for numbers, uniques and top value for text.

    Numbers and the first pass of their medians are one aggregate; text columns share one grouped count,
    so a value held by most rows is pre-aggregated before the shuffle. Of equally
    frequent top values the smallest is reported.
    """
    names = list(names if names is not None else df.columns)
    numeric = [c for c in names if is_numeric(df, c)]
    text = [c for c in names if not is_numeric(df, c)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(numeric):
        x = _clean(df, c)
        aggs += [
            F.count(x).alias(f"k{i}"), F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"),
            F.count(F.when(x == 0, x)).alias(f"z{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
    medians, row = quantiles_beside(df, numeric, [0.5], aggs)
    found = {}
    if text:
        counts = value_counts_long(df, text)
        per = counts.groupBy("column").agg(
            F.sum("n").alias("present"),
            F.count(F.lit(1)).alias("n_unique"),
            F.min(F.struct((-F.col("n")).alias("minus"), F.col("value"))).alias("top"),
            (F.sum(F.length("value") * F.col("n")) / F.sum("n")).alias("avg_length"),
        )
        found = {r["column"]: r for r in per.collect()}
    rows = []
    blank = dict.fromkeys(
        ("mean", "std", "zeros", "min", "median", "max", "n_unique", "top", "top_freq", "avg_length")
    )
    for i, c in enumerate(numeric):
        kind = "FLOAT" if isinstance(df.schema[c].dataType, (T.FractionalType,)) else "INT"
        rows.append(blank | {
            "feature": c, "type": kind, "n_rows": row["n"], "n_missing": row["n"] - row[f"k{i}"],
            "mean": row[f"m{i}"], "std": row[f"s{i}"], "zeros": row[f"z{i}"],
            "min": row[f"l{i}"], "median": medians[c][0], "max": row[f"h{i}"],
        })
    for c in text:
        hit = found.get(c)
        rows.append(blank | {
            "feature": c, "type": "BYTES", "n_rows": row["n"], "n_missing": row["n"] - (hit["present"] if hit else 0),
            "n_unique": hit["n_unique"] if hit else 0, "top": hit["top"]["value"] if hit else None,
            "top_freq": -hit["top"]["minus"] if hit else None, "avg_length": hit["avg_length"] if hit else None,
        })
    return _long(df, rows, STATS_SCHEMA)


def feature_stats_by(df: DataFrame, by: str, names: Iterable[str] | None = None) -> DataFrame:
    """`feature_stats` of each group (of a split, say): the column `by` and a row for every feature of every group.

    Any number of groups; nothing reaches the driver. Numbers share one aggregate, medians take two passes a feature.
    """
    names = [c for c in (names if names is not None else df.columns) if c != by]
    numeric = [c for c in names if is_numeric(df, c)]
    text = [c for c in names if not is_numeric(df, c)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(numeric):
        x = _clean(df, c)
        aggs += [
            F.count(x).alias(f"k{i}"), F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"),
            F.count(F.when(x == 0, x)).alias(f"z{i}"), F.min(x).cast("double").alias(f"l{i}"), F.max(x).cast("double").alias(f"h{i}"),
        ]
    wide = materialise(df.groupBy(q(by).alias("_by")).agg(*aggs), "group-moments")
    out = None
    if numeric:
        cells = F.explode(F.array(*[F.struct(
            F.lit(c).alias("feature"), F.lit("FLOAT" if isinstance(df.schema[c].dataType, T.FractionalType) else "INT").alias("type"),
            F.col("n").alias("n_rows"), (F.col("n") - F.col(f"k{i}")).alias("n_missing"), F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"), F.col(f"z{i}").alias("zeros"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"))
            for i, c in enumerate(numeric)]))
        medians = None
        for c in numeric:
            own = grouped_quantile(df.select(q(by).alias("_g"), _clean(df, c).alias("_v")), "_g", "_v", 0.5).select(
                F.col("group").alias("_g"), F.lit(c).alias("_f"), F.col("quantile").alias("median"))
            medians = own if medians is None else medians.unionByName(own)
        out = wide.select("_by", cells.alias("s")).select("_by", "s.*").join(
            medians, F.col("_by").eqNullSafe(F.col("_g")) & (F.col("feature") == F.col("_f")), "left").drop("_g", "_f")
    if text:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("string").alias("value")) for c in text]))
        counts = df.select(q(by).alias("_g"), cells.alias("c")).filter(F.col("c.value").isNotNull()).groupBy(
            "_g", F.col("c.feature").alias("_f"), F.col("c.value").alias("value")).agg(F.count(F.lit(1)).alias("k"))
        per = counts.groupBy("_g", "_f").agg(
            F.sum("k").alias("present"), F.count(F.lit(1)).alias("n_unique"),
            F.min(F.struct((-F.col("k")).alias("minus"), F.col("value"))).alias("top"),
            (F.sum(F.length("value") * F.col("k")) / F.sum("k")).alias("avg_length"))
        every = wide.select("_by", F.col("n").alias("n_rows"), F.explode(F.array(*[F.lit(c) for c in text])).alias("feature"))
        found = every.join(per, F.col("_by").eqNullSafe(F.col("_g")) & (F.col("feature") == F.col("_f")), "left").select(
            "_by", "feature", F.lit("BYTES").alias("type"), "n_rows", (F.col("n_rows") - F.coalesce("present", F.lit(0))).alias("n_missing"),
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"), F.col("top.value").alias("top"),
            (-F.col("top.minus")).alias("top_freq"), "avg_length")
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    kinds = [field.split() for field in STATS_SCHEMA.split(", ")]
    if out is None:
        return wide.limit(0).select(F.col("_by").alias(by), *[F.lit(None).cast(kind).alias(c) for c, kind in kinds])
    have = set(out.columns)
    return out.select(F.col("_by").alias(by), *[(F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in kinds])


def histogram(df: DataFrame, name: str, low: float, high: float, bins: int = 10) -> DataFrame:
    """(bin, n): equal-width counts; values outside go to bins 0 and bins+1."""
    return (
        df.select(F.width_bucket(_clean(df, name), F.lit(low), F.lit(high), F.lit(bins)).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
