from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import cleaning
from millrace.operators import encoding, evaluating, sampling, selecting, validating
from millrace.session import SMALL_ROWS

NAN = float("nan")


def test_a_sample_of_a_balanced_table_stays_balanced(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "YES").otherwise("NO").alias("y"))
    split = sampling.stratified_split(df, "k", "y", 0.2)
    balanced = sampling.undersample(split.where(~F.col("is_test")), "k", "y", "auto")
    drawn = {r.y: r["count"] for r in sampling.sample_rows(balanced, "k", 800).groupBy("y").count().collect()}
    assert sum(drawn.values()) == 800 and abs(drawn["YES"] - 400) < 80
    folds = sampling.kfold(balanced, "k", "y", 4).groupBy("fold", "y").count().collect()
    assert len(folds) == 8 and {r["count"] for r in folds} == {400}


def test_nan_is_missing_in_scores_and_clipping(spark):
    rows = [(float(i), NAN if i == 3 else float(i * 7 % 11), i % 2 * 100.0 + i % 3, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k double, noise double, signal double, y int")
    scores = {r.feature: r.f_score for r in selecting.anova_scores(df, ["noise", "signal"], "y").collect()}
    assert scores["noise"] is not None and scores["noise"] == scores["noise"] and scores["signal"] > scores["noise"]
    assert selecting.select_k_best(df, ["noise", "signal"], "y", 1).columns == ["signal"]
    clipped, over = cleaning.clip_large(spark.createDataFrame([(1e12,), (NAN,), (None,)], "x double"), ["x"])
    assert over == {"x": 1e12} and clipped.where("x = 1e10").count() == 1


@pytest.mark.parametrize("per_bucket", [200_000, 10])
def test_rows_without_a_score_have_no_part_in_the_curve(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(evaluating, "SCORES_PER_BUCKET", per_bucket)
    rows = [(i / 100, i % 3 == 0) for i in range(100)]
    area = [evaluating.roc_auc(spark.createDataFrame(r, "s double, y boolean"), "s", F.col("y")).first()[0]
            for r in (rows, [*rows, (None, True), (NAN, False), (NAN, True), (0.5, None)])]
    assert area[0] == area[1]


def test_null_is_a_class_of_the_confusion_matrix(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, "a"), (None, None)], "t string, p string")
    found = {r["label"]: (r["pred_None"], r["pred_a"]) for r in evaluating.confusion_matrix(df, "t", "p").collect()}
    assert found == {"a": (1, 1), None: (1, 1)}


def test_vocabularies_keep_types_and_are_held_by_column(spark):
    day = datetime.date(2020, 1, 1)
    rows = [(i, day + datetime.timedelta(days=i % 300), "xyz"[i % 3], i % 2 == 0) for i in range(SMALL_ROWS + 10)]
    df = spark.createDataFrame(rows, "id long, day date, short string, flag boolean")
    for columns in (["day", "short", "flag"], ["id", "day", "short", "flag"]):
        found = encoding.fit_vocabularies(df, columns)
        coded = encoding.apply_vocabulary(df, found["day"], "error", "coded").where("coded <> datediff(day, date'2020-01-01')")
        assert coded.count() == 0 and len(found["day"].values) == 300
        hot = encoding.one_hot(df.limit(6), [found["short"], found["flag"]])
        assert hot.columns == ["id", "day", "short_x", "short_y", "short_z", "flag_false", "flag_true"]
        assert all(r.short_x + r.short_y + r.short_z == 1 and r.flag_false + r.flag_true == 1 for r in hot.collect())
    assert encoding.fit_vocabularies(df, ["id", "short"])["id"].values is None


def test_domains_of_any_size(spark):
    df = spark.range(900).select(F.concat(F.lit("v"), F.col("id")).alias("code"))
    constraints, domains = validating.infer_constraints(df), validating.infer_domains(df)
    assert constraints[0].enum is None
    assert validating.anomalies(df, constraints, domains=domains).collect() == []
    wrong = df.unionByName(spark.createDataFrame([("w",), ("w",), ("u",)], "code string"))
    assert [tuple(r) for r in validating.anomalies(wrong, constraints, domains=domains).collect()] == [("code", "unexpected_value", 3)]
