"""Feature lists, declared table schemas and column contracts."""

from __future__ import annotations

from collections.abc import Sequence

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are numeric, categorical, label and row key.

    The order is part of the contract: numeric features first, then categorical.
    """

    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    label: str | None = None
    key: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)

    def present_in(self, columns: list[str], case_sensitive: bool = False) -> FeatureSpec:
        """The same spec without the columns the table does not have.

        With `case_sensitive` the name must match exactly, as it does after a
        database has folded identifiers to lower case.
        """
        have = set(columns) if case_sensitive else {c.lower() for c in columns}
        keep = lambda names: tuple(
            n for n in names if (n if case_sensitive else n.lower()) in have
        )
        return FeatureSpec(keep(self.numeric), keep(self.categorical), self.label, self.key, self.extra)


def require_columns(df: DataFrame, required: list[str] | tuple[str, ...], what: str = "table") -> DataFrame:
    """Return `df`, or fail naming every required column it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")
    return df


def split_columns(df: DataFrame, spec: FeatureSpec) -> tuple[DataFrame, DataFrame]:
    """Numeric and categorical projections of `df`, as declared (not guessed) by `spec`."""
    return df.select(*spec.numeric), df.select(*spec.categorical)


def _struct(**fields: str) -> T.StructType:
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields.items()])


# The column names of the data sets the flows are written for.
COVER_NUMERIC = (
    "Elevation", "Aspect", "Slope", "Horizontal_Distance_To_Hydrology",
    "Vertical_Distance_To_Hydrology", "Horizontal_Distance_To_Roadways",
    "Hillshade_9am", "Hillshade_Noon", "Hillshade_3pm", "Horizontal_Distance_To_Fire_Points",
)
COVER_CATEGORICAL = ("Wilderness_Area", "Soil_Type")
COVER_SPEC = FeatureSpec(COVER_NUMERIC, COVER_CATEGORICAL, label="Cover_Type")
# Position of every value in one row of the array-of-arrays batch.
COVER_BATCH_FIELDS = (*COVER_NUMERIC, *COVER_CATEGORICAL, "Cover_Type")
COVER_SCHEMA = _struct(
    **{c: "double" for c in COVER_NUMERIC}, Wilderness_Area="string", Soil_Type="string",
    Cover_Type="int", batch_number="int",
)

PENGUIN_MEASURES = ("culmen_length_mm", "culmen_depth_mm", "flipper_length_mm", "body_mass_g")
PENGUIN_SPEC = FeatureSpec(PENGUIN_MEASURES, ("island", "sex"), label="species")
PENGUIN_SCHEMA = _struct(
    species="string", island="string", **{c: "double" for c in PENGUIN_MEASURES}, sex="string",
)
# The layout of the measurement file with spaces and units in its names.
PENGUIN_SURVEY_SPEC = FeatureSpec(
    (
        "Culmen Length (mm)", "Culmen Depth (mm)", "Flipper Length (mm)", "Body Mass (g)",
        "Delta 15 N (o/oo)", "Delta 13 C (o/oo)",
    ),
    ("Island", "Sex"),
    label="Species",
)

ENCOUNTER_NUMERIC = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
)
ENCOUNTER_CATEGORICAL = (
    "race", "gender", "age", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "diabetesMed", "max_glu_serum", "A1Cresult",
)
ENCOUNTER_SPEC = FeatureSpec(
    ENCOUNTER_NUMERIC, ENCOUNTER_CATEGORICAL, label="readmitted", key="encounter_id"
)
ENCOUNTER_DRUGS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin", "glyburide_metformin",
    "glipizide_metformin", "glimepiride_pioglitazone", "metformin_rosiglitazone",
    "metformin_pioglitazone",
)
# Columns judged uninformative by the >99 % rule, with the secondary diagnoses and payer data.
ENCOUNTER_UNINFORMATIVE = (
    "repaglinide", "nateglinide", "chlorpropamide", "acetohexamide", "glipizide", "tolbutamide",
    "acarbose", "miglitol", "troglitazone", "tolazamide", "glyburide_metformin",
    "glipizide_metformin", "glimepiride_pioglitazone", "metformin_rosiglitazone",
    "metformin_pioglitazone", "payer_code", "medical_specialty", "diag_2", "diag_3",
)
ENCOUNTER_SCHEMA = _struct(
    encounter_id="int", patient_nbr="int", race="string", gender="string", age="string",
    weight="string", admission_type_id="int", discharge_disposition_id="int",
    admission_source_id="int", time_in_hospital="int", payer_code="string",
    medical_specialty="string", num_lab_procedures="int", num_procedures="int",
    num_medications="int", number_outpatient="int", number_emergency="int", number_inpatient="int",
    diag_1="string", diag_2="string", diag_3="string", number_diagnoses="int",
    max_glu_serum="string", A1Cresult="string", **{c: "string" for c in ENCOUNTER_DRUGS},
    change_column="string", diabetesMed="string", readmitted="string",
)


def processed_schema(n_features: int) -> T.StructType:
    """`feature_0 .. feature_{n-1}` doubles and a string target."""
    return _struct(**{f"feature_{i}": "double" for i in range(n_features)}, target="string")


def prediction_schema(n_features: int = 15, kinds: Sequence[str] | None = None) -> T.StructType:
    """The prediction log: id, model, inputs (of `kinds`, by default coded integers), predicted label."""
    kinds = list(kinds) if kinds is not None else ["int"] * n_features
    return _struct(id="long", model_name="string", **{f"feature_{i}": k for i, k in enumerate(kinds, 1)}, label="string")


TABLES: dict[str, T.StructType] = {
    "penguins": PENGUIN_SCHEMA,
    "soils": COVER_SCHEMA,
    "encounters_train": ENCOUNTER_SCHEMA,
    "encounters_validation": ENCOUNTER_SCHEMA,
    "encounters_test": ENCOUNTER_SCHEMA,
    "predictions": prediction_schema(),
}
