"""Feature scores, profiles and prediction quality against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import evaluating, profiling, selecting
from millrace.plans import cover
from millrace.spec import FeatureSpec


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 300)
    data = [
        (int(c), float(c + rng.normal()), float(1e9 + rng.normal()), float(rng.normal() + 3 * c), "a" if c == 0 else "bc"[rng.integers(2)])
        for c in y
    ]
    return spark.createDataFrame(data, "y int, weak double, far double, strong double, s string").persist()


def f_value(x, y):
    groups = [x[y == c] for c in np.unique(y)]
    grand = x.mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / (len(groups) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - len(groups))
    return between / within


def test_anova_matches_the_definition(labelled):
    pdf = labelled.toPandas()
    got = {r["feature"]: r["f_score"] for r in selecting.anova_scores(labelled, ["weak", "far", "strong"], "y").collect()}
    for name, value in got.items():
        assert value == pytest.approx(f_value(pdf[name].to_numpy(), pdf["y"].to_numpy()), rel=1e-4), name


def test_anova_without_spread_or_classes(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 1.0), (1, 5.0, 1.0)], "y int, x double, c double")
    assert dict(selecting.anova_scores(df, ["c"], "y").select("feature", "f_score").collect()) == {"c": None}
    assert selecting.anova_scores(df.filter("y = 0"), ["x"], "y").first()["f_score"] is None


def test_chi2_counts_only_the_ones(labelled):
    pdf = labelled.toPandas()
    got = {r["value"]: r["chi2"] for r in selecting.chi2_scores(labelled, ["s"], "y").collect()}
    for value, chi2 in got.items():
        hot = (pdf["s"] == value).to_numpy()
        observed = np.array([hot[pdf["y"] == c].sum() for c in range(3)])
        expected = np.array([(pdf["y"] == c).mean() for c in range(3)]) * hot.sum()
        assert chi2 == pytest.approx(((observed - expected) ** 2 / expected).sum()), value


def test_best_features_keep_input_order_and_late_ties(spark, labelled):
    assert selecting.select_k_best(labelled, ["strong", "far", "weak"], "y", 2).columns == ["strong", "weak"]
    scores = spark.createDataFrame([(0, "a", 1.0), (1, "b", 1.0), (2, "c", None), (3, "d", 0.5)], "position int, feature string, score double")
    assert selecting.best_features(scores, "score", "feature", 1, ["position"]) == ["b"]
    assert selecting.best_features(scores, "score", "feature", 3, ["position"]) == ["a", "b", "d"]
    kept = {r["feature"]: r["retain"] for r in selecting.retain_report(scores, "score", ["position"], 3).collect()}
    assert kept == {"a": True, "b": True, "c": False, "d": True}
    assert rows(selecting.elbow(scores, "score", ["position"], 2)) == [(1, 1.0), (2, 1.0)]


def test_selected_blocks_are_stacked(labelled):
    out = cover.selected_features(labelled, FeatureSpec(("weak", "far", "strong"), ("s",), "y"), 2, 2)
    assert out.columns[:2] == ["weak", "strong"] and len(out.columns) == 4
    assert out.count() == 600 and out.filter("weak IS NULL").count() == 300


def test_describe_and_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (4.0, 8.0), (float("nan"), 1.0), (7.0, 14.0)], "a double, b double")
    a = {r["column"]: r for r in profiling.describe(df, ["a", "b"]).collect()}["a"]
    x = np.array([1.0, 2.0, 4.0, 7.0])
    assert (a["count"], a["mean"], a["min"], a["max"]) == (4, 3.5, 1.0, 7.0)
    assert a["std"] == pytest.approx(x.std(ddof=1))
    assert (a["p25"], a["p50"], a["p75"]) == tuple(np.quantile(x, [0.25, 0.5, 0.75]))
    r = {(r["a"], r["b"]): r["r"] for r in profiling.correlations(df, ["a", "b"]).collect()}
    assert r[("a", "b")] == r[("b", "a")] == pytest.approx(1.0) and len(r) == 4
    assert profiling.describe(df, ["a"], approximate=1000).first()["p50"] == 2.0


def test_counts_and_dominance(spark):
    df = spark.createDataFrame([("a", 1)] * 199 + [("b", 2), (None, 2), (None, 2)], "s string, n int")
    assert rows(profiling.value_counts(df, ["s"])) == [("s", "a", 199), ("s", "b", 1)]
    assert profiling.drop_dominated(df, ["s", "n"], 0.99).columns == ["n"]
    assert profiling.drop_dominated(df, ["s", "n"], 0.999).columns == ["s", "n"]


def test_feature_statistics(spark):
    df = spark.createDataFrame([(0, 1.5, "aa"), (2, None, "b"), (4, float("nan"), "aa"), (0, 0.0, None)], "i int, x double, s string")
    got = {r["feature"]: r.asDict() for r in profiling.feature_stats(df).collect()}
    assert (got["i"]["type"], got["i"]["zeros"], got["i"]["median"], got["i"]["n_missing"]) == ("INT", 2, 1.0, 0)
    assert (got["x"]["type"], got["x"]["n_missing"], got["x"]["mean"]) == ("FLOAT", 2, 0.75)
    assert (got["s"]["top"], got["s"]["top_freq"], got["s"]["n_unique"], got["s"]["n_missing"]) == ("aa", 2, 2, 1)
    assert got["s"]["avg_length"] == pytest.approx(5 / 3)
    empty = {r["feature"]: r.asDict() for r in profiling.feature_stats(df.limit(0)).collect()}
    assert empty["s"]["n_unique"] == 0 and empty["i"]["mean"] is None
    assert profiling.table_profile(df).count() == 3


def test_binary_metrics_and_zero_denominators(spark):
    df = spark.createDataFrame([("YES", "YES"), ("YES", "NO"), ("NO", "YES"), ("NO", "NO"), ("YES", "YES")], "y string, p string")
    assert rows(evaluating.binary_metrics(df, "y", "p")) == [(0.6, 2 / 3, 2 / 3, 2 / 3)]
    none = spark.createDataFrame([("NO", "NO")], "y string, p string")
    assert rows(evaluating.binary_metrics(none, "y", "p")) == [(1.0, 0.0, 0.0, 0.0)]


def auc(scores, positive):
    pos, neg = scores[positive], scores[~positive]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_bucket", [200_000, 20])
def test_auc_with_ties_in_one_window_or_many_ranges(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(evaluating, "SCORES_PER_BUCKET", per_bucket)
    rng = np.random.default_rng(2)
    scores = np.where(rng.random(800) < 0.34, 0.5, np.round(rng.random(800), 2))  # a third share one score
    positive = rng.random(800) < scores
    df = spark.createDataFrame([(float(s), bool(p)) for s, p in zip(scores, positive)], "s double, p boolean")
    assert evaluating.roc_auc(df, "s", F.col("p")).first()[0] == pytest.approx(auc(scores, positive), abs=1e-12)
    assert evaluating.roc_auc(df.filter("p"), "s", F.col("p")).first()[0] is None


def test_report_and_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    got = {r["class"]: tuple(r)[1:] for r in evaluating.classification_report(df, "y", "p").collect()}
    assert got["a"] == (1.0, 0.5, 2 / 3, 2) and got["b"] == (1 / 3, 1.0, 0.5, 1) and got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"] == (0.5, 0.5, 0.5, 4)
    assert got["macro avg"][0] == pytest.approx(4 / 9) and got["weighted avg"][1] == pytest.approx(0.5)
    assert rows(evaluating.confusion_matrix(df, "y", "p")) == [("a", 1, 1, 0), ("b", 0, 1, 0), ("c", 0, 1, 0)]
