"""Classifiers on Spark ML: training, search, scoring, saved models."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import cos, log, pi, sqrt

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import q
from millrace.operators import landmarks
from millrace.operators.evaluating import binary_metrics, roc_auc
from millrace.operators.sampling import kfold, stratified_split

FEATURES, LABEL = "features", "label_index"
RBF_COMPONENTS = 64
# Each partition answers each step of a solver, with some kilobytes to the driver.
ROWS_PER_PARTITION = 500_000
LEAST_PARTITIONS = 4
# Relative improvement below which a solver stops.
TOLERANCE = 1e-4
# Most steps of a linear SVM, which ends by `TOLERANCE` before them unless rows are hard to part.
SVM_STEPS = 100
# Classes of a one-vs-rest model that are fitted at the same time.
CLASS_PARALLELISM = 4


def assembler(names: Sequence[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="error")


@dataclass(frozen=True)
class Moments:
    """Rows of a training table, mean and population variance of its columns."""

    rows: int
    means: tuple[float, ...]
    variances: tuple[float, ...]


def moments(df: DataFrame, names: Sequence[str]) -> Moments:
    aggs = [f(q(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(names) for k, f in (("m", F.avg), ("v", F.var_pop))]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    return Moments(row["n"], *(tuple(row[f"{k}{i}"] for i in range(len(names))) for k in "mv"))


def training_rows(df: DataFrame, names: Sequence[str], label: str, rows: int) -> DataFrame:
    """Only the inputs and the label, placed by a hash of the whole row.

    Every iteration of a solver passes over these rows. Number and content of the partitions follow
    from the data alone, so a fit that depends on them (bagging) is the same on every cluster.
    """
    atomic = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    whole = [q(c) for c in atomic]
    partitions = LEAST_PARTITIONS
    while partitions * ROWS_PER_PARTITION < rows:
        partitions *= 2
    placed = df.select(*[q(c) for c in dict.fromkeys((*names, label, *atomic))])
    placed = placed.repartition(partitions, F.xxhash64(*whole)).sortWithinPartitions(*whole)
    return placed.select(*[q(c) for c in dict.fromkeys((*names, label))])


def train_logistic(df: DataFrame, names: Sequence[str], label: str = LABEL, max_iter: int = 50) -> PipelineModel:
    """One-vs-rest logistic regression with unit regularisation strength (C = 1)."""
    n = df.count()
    base = LogisticRegression(featuresCol=FEATURES, labelCol=label, maxIter=max_iter, regParam=1.0 / max(n, 1))
    multi = OneVsRest(classifier=base, featuresCol=FEATURES, labelCol=label, parallelism=CLASS_PARALLELISM)
    return Pipeline(stages=[assembler(names), multi]).fit(training_rows(df, names, label, n))


# --------------------------------------------------------------- RBF SVM


def rbf_gamma(found: Moments, gamma: str | float = "scale") -> float:
    """'scale' = 1/(d * variance of all feature cells), 'auto' = 1/d, or a number."""
    d = len(found.means)
    if gamma == "auto":
        return 1.0 / d
    if gamma != "scale":
        return float(gamma)
    grand = sum(found.means) / d
    # variance over all cells = mean within-column variance + variance of the column means
    total = sum(v + (m - grand) ** 2 for m, v in zip(found.means, found.variances)) / d
    return 1.0 / (d * total) if total > 0 else 1.0


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rbf_statement(names: Sequence[str], gamma: float, components: int = RBF_COMPONENTS, seed: int = 42) -> str:
    """SQL for random Fourier features of the kernel exp(-gamma |x-y|^2).

    z_j(x) = sqrt(2/D) cos(w_j x + b_j) with w_j ~ N(0, 2 gamma), b_j ~ U(0, 2 pi)
    (Rahimi and Recht, 2007). The weights are literals, so the map is an ordinary
    projection that is saved with the pipeline.
    """
    rng = random.Random(seed)
    spread = sqrt(2.0 * gamma)
    lead = sqrt(2.0 / components)

    def normal() -> float:
        return sqrt(-2.0 * log(1.0 - rng.random())) * cos(2.0 * pi * rng.random())

    cells = []
    for j in range(components):
        terms = " + ".join(f"{_quoted(c)} * {spread * normal()!r}D" for c in names)
        cells.append(f"{lead!r}D * cos({terms} + {2.0 * pi * rng.random()!r}D) AS rbf_{j}")
    return f"SELECT *, {', '.join(cells)} FROM __THIS__"


def train_rbf_svm(
    df: DataFrame,
    names: Sequence[str],
    label: str = LABEL,
    c: float = 1.0,
    gamma: str | float = "scale",
    components: int = RBF_COMPONENTS,
    n_classes: int = 2,
    seed: int = 42,
    max_iter: int = SVM_STEPS,
) -> PipelineModel:
    """SVM with (approximated) RBF kernel: random Fourier features, then a linear SVM.

    Cost grows with rows * components, not with rows squared as for an exact kernel.
    """
    found = moments(df, names)
    svc = LinearSVC(featuresCol=FEATURES, labelCol=label, regParam=1.0 / (c * max(found.rows, 1)), maxIter=max_iter, tol=TOLERANCE)
    mapped = SQLTransformer(statement=rbf_statement(names, rbf_gamma(found, gamma), components, seed))
    cells = VectorAssembler(inputCols=[f"rbf_{j}" for j in range(components)], outputCol=FEATURES)
    rows = training_rows(df, names, label, found.rows)
    if n_classes != 2:
        last = OneVsRest(classifier=svc, featuresCol=FEATURES, labelCol=label, parallelism=CLASS_PARALLELISM)
        return _fit(Pipeline(stages=[mapped, cells, last]), rows)
    return _fit(Pipeline(stages=[mapped, cells, *_calibrated(svc, label)]), rows)


def _fit(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """The stages summarise, store and number the rows one after the other: only the first reads and places them."""
    rows = rows.persist()
    try:
        return pipeline.fit(rows)
    finally:
        rows.unpersist()


def _calibrated(svc: LinearSVC, label: str) -> list[Estimator]:
    """The SVM and a one-feature logistic fit that turns its margin into a probability."""
    svc = svc.copy({svc.predictionCol: "svm_prediction", svc.rawPredictionCol: "svm_margins"})
    margin = VectorAssembler(inputCols=["svm_margins"], outputCol="svm_margin")
    return [svc, margin, LogisticRegression(featuresCol="svm_margin", labelCol=label, maxIter=20, tol=TOLERANCE)]


def train_linear_svm(
    df: DataFrame, names: Sequence[str], label: str = LABEL, c: float = 1.0, max_iter: int = SVM_STEPS
) -> PipelineModel:
    """Binary linear SVM whose margin is turned into a probability by a one-feature logistic fit."""
    n = df.count()
    svc = LinearSVC(featuresCol=FEATURES, labelCol=label, regParam=1.0 / (c * max(n, 1)), maxIter=max_iter, tol=TOLERANCE)
    return _fit(Pipeline(stages=[assembler(names), *_calibrated(svc, label)]), training_rows(df, names, label, n))


def train_forest(
    df: DataFrame, names: Sequence[str], label: str = LABEL, trees: int = 100, depth: int = 8, seed: int = 42
) -> PipelineModel:
    forest = RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[assembler(names), forest]).fit(training_rows(df, names, label, df.count()))


# ----------------------------------------------------------------- search


def grid_search_rbf(
    df: DataFrame,
    names: Sequence[str],
    key: str,
    label: str = LABEL,
    costs: Sequence[float] = (1.0, 10.0),
    gammas: Sequence[str | float] = ("scale", "auto"),
    folds: int = 5,
    components: int = landmarks.LANDMARKS,
    n_classes: int = 2,
    seed: int = 42,
) -> landmarks.Search:
    """Stratified k-fold search over cost and gamma by accuracy.

    All candidates and folds, and each candidate's model of all rows, are solved in the same passes over the rows.
    """
    found = moments(df, names)
    narrow = df.select(*[q(c) for c in dict.fromkeys((*names, key, label))])
    folded = kfold(narrow, key, label, folds, seed, "fold")
    values = [(g, rbf_gamma(found, g)) for g in gammas]
    return landmarks.search(folded, names, label, "fold", costs, values, folds, n_classes, components, seed)


def train_landmark_svm(
    df: DataFrame, names: Sequence[str], label: str = LABEL, c: float = 1.0, gamma: str | float = "scale",
    components: int = landmarks.LANDMARKS, n_classes: int = 2, seed: int = 42,
) -> PipelineModel:
    """SVM with RBF kernel on landmarks, by a few Newton passes; of two classes with a probability."""
    found = moments(df, names)
    svm, _ = landmarks.train(df, names, label, c, rbf_gamma(found, gamma), n_classes, components, seed)
    if n_classes != 2:
        return svm
    margin = VectorAssembler(inputCols=["svm_margin"], outputCol="svm_margin_cell")
    proba = LogisticRegression(featuresCol="svm_margin_cell", labelCol=label, maxIter=20, tol=TOLERANCE, predictionCol="by_probability")
    rows = svm.transform(df.select(*[q(x) for x in dict.fromkeys((*names, label))]))
    fitted = Pipeline(stages=[margin, proba]).fit(rows)
    return PipelineModel([*svm.stages, *fitted.stages])


def grid_search_linear(
    df: DataFrame, names: Sequence[str], key: str, label: str = LABEL, costs: Sequence[float] = (0.1, 1.0, 10.0),
    folds: int = 2, parallelism: int = 4, seed: int = 42, max_iter: int = SVM_STEPS,
) -> CrossValidatorModel:
    n = max(df.count(), 1)
    svc = LinearSVC(featuresCol=FEATURES, labelCol=label, maxIter=max_iter, tol=TOLERANCE)
    grid = ParamGridBuilder().addGrid(svc.regParam, [1.0 / (c * n) for c in costs]).build()
    return _cross_validate(df, Pipeline(stages=[assembler(names), svc]), grid, names, key, label, folds, parallelism, seed)


def _cross_validate(df, estimator, grid, names, key, label, folds, parallelism, seed) -> CrossValidatorModel:
    judge = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=judge, numFolds=folds,
        foldCol="fold", parallelism=parallelism,
    )
    narrow = df.select(*[q(c) for c in dict.fromkeys((*names, key, label))])
    folded = kfold(narrow, key, label, folds, seed, "fold").persist()
    try:
        return search.fit(folded)
    finally:
        folded.unpersist()


# ---------------------------------------------------------------- scoring


def score(model: PipelineModel, df: DataFrame, classes: Mapping[int, str] | None = None, out: str = "predicted") -> DataFrame:
    """The input rows with the predicted class (by name when `classes` is given)."""
    index = F.col("prediction").cast("int")
    if classes is not None:
        named = F.lit(None).cast("string")
        for i, name in classes.items():
            named = F.when(index == F.lit(i), F.lit(name)).otherwise(named)
        index = named
    return model.transform(df).withColumn(out, index).select(*[q(c) for c in df.columns], out)


def score_probability(
    model: PipelineModel, df: DataFrame, positive: int = 1, out: str = "probability", predicted: str | None = "predicted"
) -> DataFrame:
    """The input rows with the probability of the positive class.

    A model without probabilities (an SVM of more than two classes) is refused: a margin is none.
    """
    scored = model.transform(df)
    if "probability" not in scored.columns:
        raise ValueError("the model gives no probabilities")
    scored = scored.withColumn(out, vector_to_array("probability")[positive])
    extra = [out]
    if predicted:
        scored = scored.withColumn(predicted, F.col("prediction").cast("int"))
        extra.append(predicted)
    return scored.select(*[q(c) for c in df.columns], *extra)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_inputs(df: DataFrame, names: Sequence[str], key: str, path: str) -> None:
    """Store what a model expects beside it: (position, name, type, example), the example from the first row."""
    types = dict(df.dtypes)
    first = df.orderBy(q(key)).limit(1)
    cells = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("name"), F.lit(types[c]).alias("type"),
            q(c).cast("string").alias("example"),
        )
        for i, c in enumerate(names)
    ])
    first.select(F.explode(cells).alias("r")).select("r.*").coalesce(1).write.mode("overwrite").json(path)


def load_inputs(spark: SparkSession, path: str) -> list[tuple[str, str, str | None]]:
    """(name, type, example) of a model's inputs, in the order the model was trained with."""
    rows = spark.read.schema("position int, name string, type string, example string").json(path)
    return [(r["name"], r["type"], r["example"]) for r in rows.orderBy("position").collect()]


def train_and_evaluate(
    df: DataFrame, names: Sequence[str], key: str, label: str = LABEL, test: float = 0.3, seed: int = 42, trees: int = 100
) -> tuple[PipelineModel, DataFrame]:
    """Stratified split, random forest on the larger part, one metric row on the rest."""
    flagged = stratified_split(df, key, label, test, seed)
    model = train_forest(flagged.filter(~F.col("is_test")), names, label, trees=trees, seed=seed)
    metrics = evaluate(score_probability(model, flagged.filter("is_test")), label)
    schema = ", ".join(f"{name} double" for name in metrics)
    return model, df.sparkSession.createDataFrame([tuple(metrics.values())], schema)


def evaluate(scored: DataFrame, label: str, positive: object = 1, probability: str = "probability") -> dict[str, float]:
    """accuracy, precision, recall, f1_score and roc_auc of scored rows."""
    narrow = scored.select(q(label), "predicted", q(probability)).persist()  # the model runs once for both
    try:
        row = binary_metrics(narrow, label, "predicted", positive).first().asDict()
        row["roc_auc"] = roc_auc(narrow, probability, q(label) == F.lit(positive)).first()[0]
    finally:
        narrow.unpersist()
    return row
