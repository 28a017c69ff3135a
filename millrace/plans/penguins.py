"""Penguins: raw table to an encoded, scaled training table and a species model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import cleaning
from millrace.functions.cleaning import q
from millrace.operators import encoding, sampling, training
from millrace.spec import PENGUIN_SPEC, FeatureSpec, require_columns


def clean(df: DataFrame, spec: FeatureSpec = PENGUIN_SPEC, sentinel: tuple[str, str] = ("sex", ".")) -> DataFrame:
    """Complete rows of the declared columns without the sentinel value."""
    names = [spec.label, *spec.categorical, *spec.numeric]
    rows = cleaning.drop_missing(require_columns(df, names).select(*[q(c) for c in names]))
    return cleaning.drop_sentinel(rows, *sentinel)


def training_table(df: DataFrame, spec: FeatureSpec = PENGUIN_SPEC) -> tuple[DataFrame, dict[str, encoding.Vocabulary]]:
    """Categorical columns and label as positions, measures scaled to [0, 1]."""
    encoded, vocabularies = encoding.encode_labels(clean(df, spec), [spec.label, *spec.categorical])
    scaled = encoding.scale(encoded, encoding.fit_numeric(encoded, spec.numeric), encoding.minmax)
    return scaled, vocabularies


def train(
    table: DataFrame, key: str, features: list[str], label: str, test: float = 0.3, seed: int | str = 42
) -> tuple[PipelineModel, DataFrame]:
    """(one-vs-rest logistic model, scored test rows)."""
    flagged = sampling.random_split(table.withColumn(training.LABEL, q(label).cast("double")), key, test, seed)
    model = training.train_logistic(flagged.filter(~F.col("is_test")), features)
    return model, training.score(model, flagged.filter("is_test"))
