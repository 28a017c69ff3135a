"""Feature scores against a class label, and choosing the best features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.cleaning import q
from millrace.session import materialise


def anova_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, f_score): one-way ANOVA F of each numeric feature over the classes.

    NULL and NaN cells are left out. One pass: count, mean and population variance per class. The variances are computed
    around the class mean, so large offsets do not cancel. NULL with fewer than two
    classes or without spread inside the classes.
    """
    aggs = []
    for i, c in enumerate(features):
        x = F.nullif(q(c).cast("double"), F.lit(float("nan")))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    per_class = df.groupBy(q(label).alias("_class")).agg(*aggs)
    long = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"),
            F.col(f"m{i}").alias("m"), F.col(f"v{i}").alias("v"),
        )
        for i, c in enumerate(features)
    ]))
    rows = per_class.select(long.alias("r")).select("r.*").filter("n > 0")
    total = rows.groupBy("feature").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    spread = F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2))
    within = F.sum(F.col("n") * F.col("v"))
    k, n = F.count(F.lit(1)), F.sum("n")
    return (
        rows.join(F.broadcast(total), "feature")  # one row per named feature
        .groupBy("i", "feature")
        .agg(spread.alias("ssb"), within.alias("ssw"), k.alias("k"), n.alias("n"))
        .select(
            F.col("i").alias("position"),
            "feature",
            F.when(
                (F.col("k") >= 2) & (F.col("ssw") > 0) & (F.col("n") > F.col("k")),
                (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("n") - F.col("k"))),
            ).alias("f_score"),
        )
    )


def chi2_scores(df: DataFrame, categorical: Sequence[str], label: str) -> DataFrame:
    """(feature, value, chi2) of every one-hot column against the classes.

    Works on the grouped counts, for which the table is read once; the one-hot columns are never built. Only the "1"
    cells enter: observed = rows of the class with the value, expected = class share
    times rows with the value. A class without such rows adds its expected count.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("feature"), q(c).cast("string").alias("value"))
        for i, c in enumerate(categorical)
    ]))
    observed = materialise(
        df.select(q(label).alias("_class"), pairs.alias("p"))
        .select("_class", "p.*")
        .groupBy("i", "feature", "value", "_class")
        .agg(F.count(F.lit(1)).alias("o")),
        "observed",
    )
    # the counts of the first feature, missing values included, are those of the classes
    first = observed.filter("i = 0")
    n_rows = first.agg(F.sum("o")).first()[0] or 1
    shares = first.groupBy(F.col("_class").alias("_c")).agg((F.sum("o") / F.lit(n_rows)).alias("share"))
    # the window holds one row per class for each value, and its shuffle serves the sums below
    same_value = Window.partitionBy("i", "feature", "value")
    joined = (
        observed.filter("value IS NOT NULL")
        .withColumn("n_value", F.sum("o").over(same_value))
        .join(shares, F.col("_class").eqNullSafe(F.col("_c")))
        .withColumn("e", F.col("share") * F.col("n_value"))
    )
    missing = F.col("n_value") - F.col("expected_seen")
    return (
        joined.groupBy("i", "feature", "value")
        .agg(
            F.first("n_value").alias("n_value"),
            F.sum(F.pow(F.col("o") - F.col("e"), 2) / F.col("e")).alias("seen"),
            F.sum("e").alias("expected_seen"),
        )
        .select(F.col("i").alias("position"), "feature", "value", (F.col("seen") + missing).alias("chi2"))
    )


def top_scores(scores: DataFrame, score: str, order: Sequence[str], k: int) -> DataFrame:
    """The k best rows with `rank` from 1, by falling score; ties go to the later column, missing last.

    Taken as a distributed top-k; only its k rows are numbered.
    """
    known = F.nullif(F.col(score).cast("double"), F.lit(float("nan")))
    by = [known.desc_nulls_last(), *[F.desc(c) for c in order]]
    return scores.orderBy(*by).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*by)))


def elbow(scores: DataFrame, score: str, order: Sequence[str], top: int = 10) -> DataFrame:
    """(rank, score) of the best features, highest first."""
    return top_scores(scores, score, order, top).select("rank", score)


def retain_report(scores: DataFrame, score: str, order: Sequence[str], k: int) -> DataFrame:
    """The score table with `retain`: is the feature among the k best?"""
    best = top_scores(scores, score, order, k).select(*order, F.lit(True).alias("_kept"))
    return (
        scores.join(F.broadcast(best), list(order), "left")  # k rows
        .withColumn("retain", F.coalesce("_kept", F.lit(False)))
        .drop("_kept")
    )


def best_features(scores: DataFrame, score: str, name: str, k: int, order: Sequence[str]) -> list[str]:
    """Names of the k best features in input order."""
    return [row[0] for row in top_scores(scores, score, order, k).orderBy(*order).select(name).collect()]


def select_k_best(
    df: DataFrame, features: Sequence[str], label: str, k: int = 4, keep: Sequence[str] = ()
) -> DataFrame:
    """Kept columns and the k numeric features with the highest F score, in input order."""
    chosen = best_features(anova_scores(df, features, label), "f_score", "feature", k, ["position"])
    return df.select(*[q(c) for c in (*keep, *chosen)])


def select_k_best_values(
    df: DataFrame, categorical: Sequence[str], label: str, k: int = 9, keep: Sequence[str] = ()
) -> DataFrame:
    """Kept columns and the k one-hot columns with the highest chi2, named `<column>_<value>`.

    Only the chosen one-hot columns are built.
    """
    scores = chi2_scores(df, categorical, label)
    best = top_scores(scores, "chi2", ["position", "value"], k)
    chosen = best.orderBy("position", "value").select("feature", "value").collect()
    cells = [
        F.when(q(r["feature"]).cast("string") == F.lit(r["value"]), F.lit(1)).otherwise(F.lit(0))
        .alias(f"{r['feature']}_{r['value']}")
        for r in chosen
    ]
    return df.select(*[q(c) for c in keep], *cells)
