"""Quality of predictions, computed on grouped counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.cleaning import q
from millrace.session import SMALL_ROWS, fetch_bounded, materialise

SCORES_PER_BUCKET = 200_000
MAX_BUCKETS = 4096


def _ratio(top: Column, bottom: Column) -> Column:
    """top/bottom, 0 where the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def binary_metrics(df: DataFrame, label: str, predicted: str, positive: object = "YES") -> DataFrame:
    """One row: accuracy, precision, recall, f1_score for the positive label."""
    is_true, is_hit = q(label) == F.lit(positive), q(predicted) == F.lit(positive)
    counted = df.agg(
        F.count(F.when(is_true & is_hit, 1)).alias("tp"),
        F.count(F.when(~is_true & is_hit, 1)).alias("fp"),
        F.count(F.when(is_true & ~is_hit, 1)).alias("fn"),
        F.count(F.when(q(label) == q(predicted), 1)).alias("right"),
        F.count(F.lit(1)).alias("n"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(
        _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def roc_auc(df: DataFrame, score: str, is_positive: Column) -> DataFrame:
    """One row `roc_auc`: tied scores count half; NULL when one class is missing.

    Rows without a score (NULL or NaN) or without a class are left out.

    Rows are first counted per distinct score, which collapses a score shared by many
    rows. Few distinct scores are then summed in order in one window; many are cut
    into score ranges, summed inside each range and shifted by the ranges below.
    """
    scored = df.select(q(score).cast("double").alias("s"), is_positive.alias("p"))
    scored = scored.filter(F.col("s").isNotNull() & ~F.isnan("s") & F.col("p").isNotNull())
    per_score = scored.groupBy("s").agg(
        F.count(F.when(F.col("p"), 1)).alias("pos"), F.count(F.when(~F.col("p"), 1)).alias("neg")
    )
    per_score = materialise(per_score, "scores")
    n = per_score.count()
    if n <= SCORES_PER_BUCKET:
        ranged = per_score.withColumn("b", F.lit(0.0))
    else:
        parts = min(MAX_BUCKETS, n // SCORES_PER_BUCKET + 1)
        cuts = per_score.agg(F.percentile_approx("s", [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
        edges = [float("-inf"), *sorted(set(cuts)), float("inf")]
        ranged = Bucketizer(splits=edges, inputCol="s", outputCol="b").transform(per_score)
    totals = ranged.groupBy("b").agg(F.sum("neg").alias("n"))
    below = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_BUCKETS rows
    offsets = totals.select("b", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("before"))
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("before") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    # whole numbers up to 2*P*N: counted exactly in decimals, whatever the order of summing
    twice = (F.col("pos").cast("decimal(18,0)") * (2 * lower + F.col("neg")).cast("decimal(19,0)"))
    summed = ranged.join(F.broadcast(offsets), "b").select("pos", "neg", twice.alias("t")).agg(
        F.sum("t").alias("t"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    area = F.col("t").cast("double") / (2.0 * F.col("p").cast("double") * F.col("n").cast("double"))
    return summed.select(F.when((F.col("p") > 0) & (F.col("n") > 0), area).alias("roc_auc"))


def confusion_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(label, predicted, n) for the pairs that occur."""
    return df.groupBy(q(label).alias("label"), q(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: Sequence | None = None) -> DataFrame:
    """One row per true class, one column `pred_<class>` per predicted class."""
    counts = confusion_counts(df, label, predicted)
    if classes is None:
        seen = fetch_bounded(counts.select("predicted").union(counts.select("label")).distinct(), SMALL_ROWS)
        if seen is None:
            raise ValueError("too many classes for one column each; confusion_counts has a row for each pair")
        classes = sorted((r[0] for r in seen), key=lambda c: (c is not None, c))  # NULL is a class, the first
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted").eqNullSafe(F.lit(c)), F.col("n"))), F.lit(0)).alias(f"pred_{c}")
        for c in classes
    ]
    return counts.groupBy("label").agg(*cells)


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class precision, recall, f1_score, support; then accuracy, macro and weighted averages.

    A class that is only predicted has support 0 and takes part in the macro average.
    """
    counts = confusion_counts(df, label, predicted)
    # each pair feeds its true class and its predicted class: one shuffle of small counts
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(none)
    side = lambda name, support, predicted, tp: F.struct(
        F.col(name).cast("string").alias("class"), support.alias("support"),
        predicted.alias("predicted"), tp.alias("tp"),
    )
    sides = F.explode(F.array(
        side("label", F.col("n"), none, hit), side("predicted", none, F.col("n"), none)
    ))
    per = (
        counts.select(sides.alias("s"))
        .select("s.*")
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
        .select(
            "class", "support", "tp",
            _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
            _ratio(F.col("tp"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1_score"),
        )
    )
    names = ("precision", "recall", "f1_score")
    n = F.sum("support")
    accuracy = _ratio(F.sum("tp"), n)
    whole = per.agg(
        n.alias("support"),
        accuracy.alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_ratio(F.sum(F.col(c) * F.col("support")), n).alias(f"weighted_{c}") for c in names],
    )
    averages = F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(c) for c in names], "support"),
        *[
            F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{c}").alias(c) for c in names], "support")
            for kind in ("macro", "weighted")
        ],
    ))
    return per.select("class", *names, "support").unionByName(whole.select(averages.alias("a")).select("a.*"))
