"""Forest cover: statistics, curated schema, validation, transform; feature selection; soil training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from millrace.functions import cleaning
from millrace.functions.cleaning import q
from millrace.operators import combining, encoding, selecting, validating
from millrace.spec import COVER_SPEC, FeatureSpec

# What an expert adds to the inferred schema.
CURATED = {
    "Hillshade_9am": {"int_min": 0, "int_max": 255},
    "Hillshade_Noon": {"int_min": 0, "int_max": 255},
    "Slope": {"int_min": 0, "int_max": 90},
    "Cover_Type": {"type": "BYTES", "enum": ("0", "1", "2", "3", "4", "5", "6"), "not_in_env": (validating.SERVING,)},
}


def curated_schema(df: DataFrame, changes: Mapping[str, Mapping] = CURATED) -> list[validating.Constraint]:
    """Constraints inferred from the table, then corrected by hand."""
    return validating.curate(validating.infer_constraints(df), changes)


def preprocessing(spec: FeatureSpec = COVER_SPEC):
    """z-scores of the numeric columns, frequency vocabularies of the categorical ones."""

    def function(analyzer: encoding.Analyzer) -> dict[str, Column]:
        out = {c: analyzer.z_score(c) for c in spec.numeric}
        return out | {c: analyzer.vocabulary(c) for c in spec.categorical}

    return function


def transform(df: DataFrame, spec: FeatureSpec = COVER_SPEC, keep: Sequence[str] = ()) -> tuple[DataFrame, encoding.Analyzer]:
    return encoding.run_preprocessing(df, preprocessing(spec), keep)


def selected_features(
    df: DataFrame, spec: FeatureSpec = COVER_SPEC, k_numeric: int = 4, k_categorical: int = 9
) -> DataFrame:
    """Best min-max scaled numeric columns and best one-hot columns, stacked by rows.

    The two blocks have different columns, so each row is NULL in the other block.
    """
    scaled = encoding.scale(df, encoding.fit_numeric(df, spec.numeric), encoding.minmax)
    numeric = selecting.select_k_best(scaled, spec.numeric, spec.label, k_numeric)
    categorical = selecting.select_k_best_values(df, spec.categorical, spec.label, k_categorical)
    return combining.stack_rows(numeric, categorical)


def training_table(df: DataFrame, spec: FeatureSpec = COVER_SPEC, encode: Sequence[str] = ("Wilderness_Area", "Soil_Type"),
                   scale: Sequence[str] | None = None) -> DataFrame:
    """Rows without missing values, categorical columns encoded, then min-max scaled.

    A column may be in both lists; it is encoded first.
    """
    rows = cleaning.drop_missing(df.select(*[q(c) for c in (*spec.features, spec.label)]))
    encoded, _ = encoding.encode_labels(rows, list(encode))
    scaled = list(scale if scale is not None else (*spec.numeric, "Wilderness_Area"))
    return encoding.scale(encoded, encoding.fit_numeric(encoded, scaled), encoding.minmax)
