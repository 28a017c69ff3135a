from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import landmarks, training

NAMES = ["a", "b"]


def kernel(x, y, gamma):
    return np.exp(-gamma * ((x[:, None] - y[None]) ** 2).sum(axis=2))


def exact_svm(x, y, cost, gamma, rounds=4000):
    """A kernel SVM with hinge loss in its dual form, by coordinate ascent; the constant is a kernel of its own."""
    k = kernel(x, x, gamma) + 1.0
    alpha, out = np.zeros(len(x)), np.zeros(len(x))
    draw = np.random.default_rng(0)
    for _ in range(rounds // 100):
        for i in draw.permutation(len(x)):
            new = min(max(alpha[i] + (1 - y[i] * out[i]) / k[i, i], 0.0), cost)
            out += (new - alpha[i]) * y[i] * k[i]
            alpha[i] = new
    return lambda other: (kernel(other, x, gamma) + 1.0) @ (alpha * y)


@pytest.fixture(scope="module")
def overlapping(spark):
    draw = np.random.default_rng(5)
    label = draw.integers(0, 2, 700)
    angle = draw.uniform(0, np.pi, 700) + np.pi * label
    xy = np.stack([np.cos(angle) + label, np.sin(angle) + 0.3 * label], axis=1) + draw.normal(0, 0.35, (700, 2))
    data = [(i, float(p), float(r), float(c)) for i, ((p, r), c) in enumerate(zip(xy, label, strict=True))]
    return spark.createDataFrame(data, "k long, a double, b double, label_index double").persist(), xy, label


def test_close_to_an_exact_kernel_machine(overlapping):
    df, xy, label = overlapping
    train, test = df.filter("k % 2 = 0"), df.filter("k % 2 = 1")
    for cost, gamma in ((1.0, 1.0), (10.0, 0.5)):
        exact = exact_svm(xy[::2], np.where(label[::2] == 1, 1.0, -1.0), cost, gamma)
        want = np.mean((exact(xy[1::2]) > 0) == label[1::2])
        model = training.train_landmark_svm(train, NAMES, c=cost, gamma=gamma)
        got = training.score(model, test).filter("predicted = label_index").count() / 350
        assert want > 0.75 and abs(got - want) <= 0.0201  # 7 of 350 rows


def test_least_loss_and_gradient(overlapping):
    """The weights that come out have the least loss: no other step from them is better."""
    df, xy, label = overlapping
    points = landmarks.choose_landmarks(df, NAMES, 20)
    own = landmarks.KernelMap(points, 0.7)
    fits = [landmarks.Fit(0, 3.0, 1.0), landmarks.Fit(0, 0.01, 1.0)]
    assert landmarks.solve(df, NAMES, "label_index", None, [own], fits) < 25
    z, y = own(xy), np.where(label == 1, 1.0, -1.0)
    for fit in fits:
        def loss(w):
            return w[:-1] @ w[:-1] / 2 + fit.cost * (np.maximum(1 - y * (z @ w), 0) ** 2).sum()  # noqa: B023
        assert fit.loss == pytest.approx(loss(fit.weights))
        draw = np.random.default_rng(1)
        for _ in range(200):
            assert loss(fit.weights + draw.normal(0, 0.02, len(fit.weights))) > fit.loss * (1 - 2 * landmarks.TOLERANCE)


def test_map_approximates_the_kernel():
    draw = np.random.default_rng(2)
    points, x = draw.normal(0, 1, (60, 2)), draw.normal(0, 0.7, (40, 2))
    z = landmarks.KernelMap(points, 0.3)(x)[:, :-1]
    assert np.abs(z @ z.T - kernel(x, x, 0.3)).max() < 0.02
    same = landmarks.KernelMap(points, 0.3)(points)[:, :-1]
    assert np.abs(same @ same.T - kernel(points, points, 0.3)).max() < 1e-6


def test_search_chooses_as_separate_fits(overlapping):
    df, _, _ = overlapping
    costs, gammas, folds = (0.01, 1.0, 30.0), (0.05, 2.0), 3
    found = training.grid_search_rbf(df, NAMES, "k", costs=costs, gammas=gammas, folds=folds, components=24)
    assert found.candidates == [(c, g) for g in gammas for c in costs]
    from millrace.operators.sampling import kfold

    folded = kfold(df, "k", "label_index", folds, 42, "fold").persist()
    points = landmarks.choose_landmarks(folded, NAMES, 24)
    for (cost, gamma), mean in zip(found.candidates, found.avgMetrics, strict=True):
        shares = []
        for fold in range(folds):
            own, fit = landmarks.KernelMap(points, gamma), landmarks.Fit(0, cost, 1.0)
            landmarks.solve(folded.filter(F.col("fold") != fold), NAMES, "label_index", None, [own], [fit])
            scored = landmarks.model_of(NAMES, own, [fit]).transform(folded.filter(F.col("fold") == fold))
            shares.append(scored.agg(F.avg((F.col("prediction") == F.col("label_index")).cast("double"))).first()[0])
        assert mean == pytest.approx(np.mean(shares), abs=0.006)
    assert found.best == int(np.argmax(found.avgMetrics))
    right = training.score(found.bestModel, df).filter("predicted = label_index").count() / 700
    assert right > max(found.avgMetrics) - 0.03


def test_three_classes_and_saved_model(spark, tmp_path):
    draw = np.random.default_rng(1)
    data = [(i, float(i % 3 * 2 + draw.normal(0, 0.3)), float(draw.normal()), float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(data, "k long, a double, `b c` double, label_index double")
    names = ["a", "b c"]
    model = training.train_landmark_svm(df, names, n_classes=3)
    assert training.score(model, df).filter("predicted = label_index").count() > 285
    training.save_model(model, str(tmp_path / "m"))
    again = training.load_model(str(tmp_path / "m"))
    assert sorted(training.score(again, df).collect()) == sorted(training.score(model, df).collect())
    assert training.grid_search_rbf(df, names, "k", folds=2, n_classes=3, costs=(1.0,)).avgMetrics[0] > 0.9


def test_degenerate_rows(spark):
    same = spark.createDataFrame([(i, 1.0, 1.0, float(i % 4 == 0)) for i in range(40)], "k long, a double, b double, label_index double")
    model = training.train_landmark_svm(same, NAMES, gamma=1.0)
    assert training.score(model, same).filter("predicted = 0").count() == 40  # the larger class
    one = same.filter("label_index = 1")
    assert training.score(landmarks.train(one, NAMES, "label_index", 1.0, 1.0)[0], one).filter("predicted = 1").count() == 10
