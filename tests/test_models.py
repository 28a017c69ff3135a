from __future__ import annotations

import json
import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.catalog import model_queries, stream_queries
from millrace.operators import sampling, training, validating
from millrace.plans import encounters, penguins
from millrace.spec import ENCOUNTER_CATEGORICAL, ENCOUNTER_NUMERIC
from millrace.streaming import scoring

NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def ring(spark):
    """Two classes a straight line cannot part: inside and outside of a circle."""
    rng = np.random.default_rng(0)
    xy = rng.uniform(-1, 1, (800, 2))
    data = [(i, float(x), float(y), float(x * x + y * y < 0.5)) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(data, "k long, a double, b double, label_index double").persist()


@pytest.fixture(scope="module")
def three(spark):
    rng = np.random.default_rng(1)
    data = [(i, float(i % 3 * 2 + rng.normal(0, 0.3)), float(rng.normal()), float(i % 3)) for i in range(300)]
    return spark.createDataFrame(data, "k long, a double, b double, label_index double").persist()


def accuracy(model, df):
    return training.score(model, df).filter("predicted = label_index").count() / df.count()


def test_rbf_beats_the_line(ring):
    rbf = training.train_rbf_svm(ring, NAMES, gamma=2.0, components=64, max_iter=30)
    line = training.train_linear_svm(ring, NAMES)
    assert accuracy(rbf, ring) > 0.93 > 0.75 > accuracy(line, ring)


def test_random_features_approximate_the_kernel(spark):
    points = [(0.1, 0.2), (0.4, -0.3), (-0.5, 0.9)]
    df = spark.createDataFrame(points, "a double, b double").createOrReplaceTempView("points")
    assert df is None
    sql = training.rbf_statement(NAMES, 0.7, components=1500).replace("__THIS__", "points")
    z = np.array([list(r)[2:] for r in spark.sql(sql).collect()])
    exact = np.array([[math.exp(-0.7 * ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2)) for q in points] for p in points])
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_gamma(spark):
    df = spark.createDataFrame([(0.0, 2.0), (2.0, 4.0)], "a double, b double")
    found = training.moments(df, NAMES)
    assert found.rows == 2
    assert training.rbf_gamma(found) == pytest.approx(1 / (2 * np.var([0, 2, 2, 4])))
    assert (training.rbf_gamma(found, "auto"), training.rbf_gamma(found, 3)) == (0.5, 3.0)
    assert training.rbf_gamma(training.moments(df.limit(1), ["a"])) == 1.0


def test_three_classes(three):
    assert accuracy(training.train_logistic(three, NAMES), three) > 0.95
    assert accuracy(training.train_rbf_svm(three, NAMES, n_classes=3, components=32), three) > 0.9
    assert accuracy(training.train_forest(three, NAMES, trees=10, depth=4), three) > 0.95


def test_grid_search_prefers_the_fitting_kernel(ring):
    found = training.grid_search_rbf(ring, NAMES, "k", costs=(1.0,), gammas=(2.0, 1e-6), folds=2, components=32)
    assert found.avgMetrics[0] > found.avgMetrics[1] + 0.1
    assert accuracy(found.bestModel, ring) > 0.85
    assert len(training.grid_search_linear(ring, NAMES, "k", costs=(0.1, 1.0)).avgMetrics) == 2


def test_evaluation_and_saved_model(spark, ring, tmp_path):
    model, metrics = training.train_and_evaluate(ring, NAMES, "k", trees=20)
    row = metrics.first()
    assert row["accuracy"] > 0.85 and row["roc_auc"] > 0.9 and 0 < row["f1_score"] <= 1
    training.save_model(model, str(tmp_path / "m"))
    again = training.load_model(str(tmp_path / "m"))
    assert rows(training.score(again, ring)) == rows(training.score(model, ring))
    proba = training.score_probability(again, ring)
    assert proba.filter("probability < 0 OR probability > 1").count() == 0
    assert proba.filter("(probability > 0.5) != (predicted = 1) AND probability != 0.5").count() == 0


def test_inputs_are_kept_beside_the_model(spark, ring, tmp_path):
    training.save_inputs(ring, ["b", "a"], "k", str(tmp_path / "inputs"))
    first = ring.filter("k = 0").first()
    assert training.load_inputs(spark, str(tmp_path / "inputs")) == [
        ("b", "double", str(first["b"])), ("a", "double", str(first["a"]))]


def test_penguin_model(three):
    table = three.withColumn("species", F.col("label_index").cast("int")).drop("label_index")
    model, scored = penguins.train(table, "k", NAMES, "species")
    assert scored.count() == 90 and scored.filter("species = predicted").count() > 80


def test_platt_probability_follows_the_margin(three):
    two = three.filter("label_index < 2")
    scored = training.score_probability(training.train_linear_svm(two, NAMES), two)
    assert scored.filter("label_index = 1").agg(F.avg("probability")).first()[0] > 0.9


def raw_encounters(spark, n=600):
    rng = np.random.default_rng(5)
    data = []
    for i in range(n):
        stay = int(rng.integers(1, 15))
        visits = int(rng.integers(0, 6))
        again = ["<30", ">30"][i % 2] if visits + rng.normal(0, 0.5) > 2.5 else "NO"
        data.append((i, "?" if i % 9 == 0 else "Caucasian", "Male" if i % 2 else "Female", "[50-60)", 1, 1, 7, stay, 40, 1, 12, 0, 0, visits, 7, "No", None, "None", again, "250.83"))
    names = (
        "encounter_id int, race string, gender string, age string, admission_type_id int, discharge_disposition_id int, admission_source_id int, "
        "time_in_hospital int, num_lab_procedures int, num_procedures int, num_medications int, number_outpatient int, number_emergency int, "
        "number_inpatient int, number_diagnoses int, diabetesMed string, max_glu_serum string, A1Cresult string, readmitted string, diag_1 string"
    )
    return spark.createDataFrame(data, names)


def test_encounter_flow(spark, tmp_path):
    prepared = encounters.prepare(encounters.clean_raw(raw_encounters(spark)))
    assert prepared.filter("race = 'Unknown'").count() == 67 and prepared.filter("max_glu_serum = 'Unknown'").count() == 600
    split = sampling.three_way_split(prepared, "encounter_id", encounters.TARGET)
    processed = encounters.process(split, "encounter_id", ENCOUNTER_NUMERIC, ENCOUNTER_CATEGORICAL)
    assert len(processed.features) == 17
    processed = processed.store(str(tmp_path / "processed"))
    model = encounters.train(processed, components=64)
    quality = encounters.measure(model, processed.part("validation"))
    majority = processed.part("validation").groupBy("target").count().agg(F.max("count")).first()[0] / processed.part("validation").count()
    assert quality["accuracy"] > max(majority, 0.7) and quality["roc_auc"] > 0.75
    assert encounters.should_promote(quality, quality) == "Production"


def test_explored_encounters(spark):
    out = encounters.explore(raw_encounters(spark, 50))
    row = out.filter("encounter_id = 1").first()
    assert row["diag_1"] == 4 and row["max_glu_serum"] == "?" and row["service_utilization"] == row["number_inpatient"]
    assert set(r[0] for r in out.select("target").distinct().collect()) <= {"YES", "NO"}


def test_stream_scoring_logs_and_rejects(spark, three, tmp_path):
    model = training.train_forest(three, NAMES, trees=5, depth=3)
    spec = validating.RecordSpec((("a", "double"), ("b", "double")))
    for i in range(3):
        path = tmp_path / "in" / f"{i}.json"
        path.parent.mkdir(exist_ok=True)
        records = [{"id": 10 * i + j, "payload": json.dumps({"a": 0.0, "b": 0.0} if j else {"a": 0.0})} for j in range(4)]
        path.write_text("\n".join(json.dumps(r) for r in records))
    stream = spark.readStream.schema("id long, payload string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    log, bad = str(tmp_path / "log"), str(tmp_path / "bad")
    for _ in range(2):
        scoring.score_stream(stream, spec, model, "id", "forest", log, bad, str(tmp_path / "p"), {0: "x", 1: "y", 2: "z"}).awaitTermination()
    logged = spark.read.parquet(log)
    assert rows(logged.select("id", "model_name", "label")) == sorted(
        [(10 * i + j, "forest", "x") for i in range(3) for j in range(1, 4)], key=repr)
    assert rows(spark.read.parquet(bad).select("id", "reason")) == [(0, "missing: b"), (10, "missing: b"), (20, "missing: b")]


def test_svm_fits_on_overlapping_rows_go_on(spark):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 600)
    xy = rng.normal(0, 1, (600, 2)) + 0.4 * label[:, None]
    data = [(i, float(x), float(y), float(c)) for i, ((x, y), c) in enumerate(zip(xy, label, strict=True))]
    df = spark.createDataFrame(data, "k long, a double, b double, label_index double")
    model = training.train_rbf_svm(df, NAMES, gamma=1.0, components=16)
    svm = next(s for s in model.stages if type(s).__name__ == "LinearSVCModel")
    assert svm.getMaxIter() == training.SVM_STEPS and svm.summary().totalIterations > 10


@pytest.mark.parametrize("query", [model_queries.registry_flow, stream_queries.stream_score])
def test_queries_grow_whole_forests(spark, monkeypatch, query):
    class Grown(Exception):
        pass

    def grow(df, names, **smaller):
        raise Grown(smaller)

    monkeypatch.setattr(training, "train_forest", grow)
    with pytest.raises(Grown) as found:
        query(spark, "/root/testdata/sf0.001")
    assert found.value.args == ({},)


def test_steps_of_a_solver_have_few_tasks(spark, ring):
    # 9 M rows: each task of each step sends some kilobytes to the driver
    assert training.training_rows(ring, NAMES, training.LABEL, 9_000_000).rdd.getNumPartitions() == 32
    assert training.training_rows(ring, NAMES, training.LABEL, 1_000_000).rdd.getNumPartitions() == 4


@pytest.mark.parametrize("train", [training.train_rbf_svm, training.train_linear_svm])
def test_svm_rows_are_placed_once(spark, ring, monkeypatch, train):
    fit, held = training.Pipeline.fit, []
    monkeypatch.setattr(training.Pipeline, "fit", lambda self, rows: (held.append((rows, rows.is_cached)), fit(self, rows))[1])
    assert train(ring, NAMES, max_iter=2) is not None
    (rows_held, cached), = held
    assert cached and not rows_held.is_cached
