"""Schema constraints for tables and records.

A constraint table has one row per feature:
feature, type (INT / FLOAT / BYTES), min_fraction, min_count, int_min, int_max,
enum (array), not_in_env (array), values_path (a stored table of the values of a longer domain).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import is_missing, q
from millrace.operators.encoding import value_counts_long
from millrace.session import materialise, scratch_path

TRAINING, SERVING = "TRAINING", "SERVING"
# Values that a constraint lists itself; a longer domain is a stored table that the constraint names.
DOMAIN_VALUES = 400

CONSTRAINT_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("min_fraction", T.DoubleType()), T.StructField("min_count", T.LongType()),
    T.StructField("int_min", T.LongType()), T.StructField("int_max", T.LongType()),
    T.StructField("enum", T.ArrayType(T.StringType())), T.StructField("not_in_env", T.ArrayType(T.StringType())),
    T.StructField("values_path", T.StringType()),
])
DOMAIN_SCHEMA = "feature string, value string"


@dataclass(frozen=True)
class Constraint:
    feature: str
    type: str
    min_fraction: float | None = 1.0
    min_count: int | None = 1
    int_min: int | None = None
    int_max: int | None = None
    enum: tuple[str, ...] | None = None
    not_in_env: tuple[str, ...] = ()
    values_path: str | None = None


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "INT"
    return "FLOAT" if isinstance(dtype, T.NumericType) else "BYTES"


def _text_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]


def infer_domains(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(feature, value): the observed values of all text columns, as a written table of any size.

    `anomalies` checks against it what the constraints do not list themselves.
    """
    found = _text_columns(df, list(names if names is not None else df.columns))
    if not found:
        return df.sparkSession.createDataFrame([], "feature string, value string")
    return materialise(value_counts_long(df, found).select(F.col("column").alias("feature"), "value"), "domains")


def infer_constraints(
    df: DataFrame, names: Sequence[str] | None = None, listed_values: int = DOMAIN_VALUES
) -> list[Constraint]:
    """Types, presence and, for text, the observed values.

    Up to `listed_values` distinct values are listed in the constraint; more are a stored table of any size that
    it names, which `anomalies` checks by an anti join. Either way a new value is found.
    """
    names = list(names if names is not None else df.columns)
    present = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(~is_missing(df, c), 1)).alias(f"k{i}") for i, c in enumerate(names)]
    ).first()
    text = _text_columns(df, names)
    domains: dict[str, tuple[str, ...]] = {}
    stored: dict[str, str] = {}
    if text:
        counts = materialise(value_counts_long(df, text), "value-counts")
        sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"))
        sized = {r["column"]: r["n_values"] for r in sizes.collect()}  # one row for each column
        short = [c for c in text if 0 < sized.get(c, 0) <= listed_values]
        long = [c for c in text if sized.get(c, 0) > listed_values]
        if long:
            path = scratch_path(df.sparkSession, "domains")
            _store_domains(counts.filter(F.col("column").isin(long)).select(F.col("column").alias("feature"), "value"), path)
            stored = dict.fromkeys(long, path)
        if short:
            listed = counts.filter(F.col("column").isin(short)).groupBy("column").agg(
                F.sort_array(F.collect_list("value")).alias("v"))
            domains = {r["column"]: tuple(r["v"]) for r in listed.collect()}
    return [
        Constraint(
            c, kind_of(df.schema[c].dataType),
            min_fraction=1.0 if present["n"] and present[f"k{i}"] == present["n"] else None,
            enum=domains.get(c), values_path=stored.get(c),
        )
        for i, c in enumerate(names)
    ]


def _store_domains(values: DataFrame, path: str) -> None:
    """One folder for each feature, so that a check reads its own values only."""
    values.withColumn("name", F.col("feature")).write.mode("overwrite").partitionBy("name").parquet(path)


def stored_domain(spark: SparkSession, constraint: Constraint) -> DataFrame:
    """(feature, value) of a constraint whose values are stored."""
    found = spark.read.schema(f"{DOMAIN_SCHEMA}, name string").parquet(constraint.values_path)
    return found.filter(F.col("name") == constraint.feature).select("feature", "value")


def curate(constraints: Sequence[Constraint], changes: Mapping[str, Mapping]) -> list[Constraint]:
    """Replace fields of single constraints, e.g. an int range, a type or an enum; a new enum replaces stored values."""
    known = {c.feature for c in constraints}
    unknown = [f for f in changes if f not in known]
    if unknown:
        raise ValueError(f"no constraint for: {', '.join(unknown)}")
    changed = ((c, changes.get(c.feature, {})) for c in constraints)
    return [replace(c, **({"values_path": None} if "enum" in new else {}), **new) for c, new in changed]


def constraint_table(spark: SparkSession, constraints: Sequence[Constraint]) -> DataFrame:
    return spark.createDataFrame(
        [
            (
                c.feature, c.type, c.min_fraction, c.min_count, c.int_min, c.int_max,
                list(c.enum) if c.enum is not None else None, list(c.not_in_env), c.values_path,
            )
            for c in constraints
        ],
        CONSTRAINT_SCHEMA,
    )


def save_constraints(spark: SparkSession, constraints: Sequence[Constraint], path: str) -> None:
    """The constraints as JSON, and their stored values beside them."""
    stored = [c for c in constraints if c.values_path is not None]
    if stored:
        values = stored_domain(spark, stored[0])
        for c in stored[1:]:
            values = values.unionByName(stored_domain(spark, c))
        beside = f"{path.rstrip('/')}-values-{uuid.uuid4().hex}"  # a new folder: what is saved may be what is read
        _store_domains(values, beside)
        constraints = [replace(c, values_path=beside) if c.values_path is not None else c for c in constraints]
    constraint_table(spark, constraints).coalesce(1).write.mode("overwrite").json(path)


def load_constraints(spark: SparkSession, path: str) -> list[Constraint]:
    """Read a saved constraint table; its size is the number of columns of a table."""
    rows = spark.read.schema(CONSTRAINT_SCHEMA).json(path).collect()
    return [
        Constraint(
            r["feature"], r["type"], r["min_fraction"], r["min_count"], r["int_min"], r["int_max"],
            tuple(r["enum"]) if r["enum"] is not None else None, tuple(r["not_in_env"] or ()), r["values_path"],
        )
        for r in rows
    ]


def _wrong_type(df: DataFrame, c: Constraint) -> Column:
    """Present values that cannot be read as the declared type."""
    kind = kind_of(df.schema[c.feature].dataType)
    if c.type == "BYTES" or kind == c.type or (kind == "INT" and c.type == "FLOAT"):
        return F.lit(False)
    text = q(c.feature).cast("string")
    if c.type == "INT":
        number = text.try_cast("double")
        return q(c.feature).isNotNull() & (number.isNull() | F.isnan(number) | (number != F.floor(number)))
    return q(c.feature).isNotNull() & text.try_cast("double").isNull()


def _out_of_range(c: Constraint) -> Column:
    number = q(c.feature).cast("string").try_cast("double")
    out = F.lit(False)
    if c.int_min is not None:
        out = out | (number < c.int_min)
    if c.int_max is not None:
        out = out | (number > c.int_max)
    return F.coalesce(out, F.lit(False))


def _out_of_enum(c: Constraint) -> Column:
    return F.coalesce(~q(c.feature).cast("string").isin(list(c.enum)), F.lit(False))


def anomalies(
    df: DataFrame, constraints: Sequence[Constraint], environment: str = TRAINING, domains: DataFrame | None = None
) -> DataFrame:
    """(feature, kind, n): violations of the constraints; no rows means valid.

    Features whose constraint names stored values are checked against these; `domains`, a table (feature, value),
    adds values for features whose constraint has none.

    kind: missing_column, wrong_type, low_presence, out_of_range, unexpected_value,
    unexpected_column. All counts come from one aggregate over the table.
    """
    applied = [c for c in constraints if environment not in c.not_in_env]
    have = set(df.columns)
    named = {c.feature for c in constraints}
    fixed: list[tuple[str, str]] = [(c.feature, "missing_column") for c in applied if c.feature not in have]
    fixed += [(name, "unexpected_column") for name in df.columns if name not in named]
    checks: list[tuple[str, str, Column]] = []
    for c in applied:
        if c.feature not in have:
            continue
        checks.append((c.feature, "wrong_type", F.count(F.when(_wrong_type(df, c), 1))))
        present = F.count(F.when(~is_missing(df, c.feature), 1))
        n = F.count(F.lit(1))
        low = F.lit(False)
        if c.min_fraction is not None:
            low = low | (present < n * F.lit(c.min_fraction))
        if c.min_count is not None:
            low = low | (present < F.lit(c.min_count))
        checks.append((c.feature, "low_presence", F.when(low, F.greatest(n - present, F.lit(1))).otherwise(F.lit(0))))
        if c.int_min is not None or c.int_max is not None:
            checks.append((c.feature, "out_of_range", F.count(F.when(_out_of_range(c), 1))))
        if c.enum is not None:
            checks.append((c.feature, "unexpected_value", F.count(F.when(_out_of_enum(c), 1))))
    cells = [
        F.struct(F.lit(f).alias("feature"), F.lit(k).alias("kind"), F.lit(1).cast("bigint").alias("n")) for f, k in fixed
    ]
    cells += [
        F.struct(F.lit(f).alias("feature"), F.lit(k).alias("kind"), F.col(f"x{i}").cast("bigint").alias("n"))
        for i, (f, k, _) in enumerate(checks)
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, kind string, n bigint")
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[col.alias(f"x{i}") for i, (_, _, col) in enumerate(checks)])
    found = wide.select(F.explode(F.array(*cells)).alias("a")).select("a.*").filter("n > 0")
    unlisted = [c.feature for c in applied if c.feature in have and c.enum is None and (domains is not None or c.values_path)]
    if not unlisted:
        return found
    for c in applied:
        if c.feature in unlisted and c.values_path is not None:
            own = stored_domain(df.sparkSession, c)
            domains = own if domains is None else domains.select("feature", "value").filter(F.col("feature") != c.feature).unionByName(own)
    counts = value_counts_long(df, unlisted).withColumnRenamed("column", "feature")
    counts = counts.join(domains.select("feature").distinct(), "feature", "left_semi")
    outside = counts.join(domains.select("feature", "value").distinct(), ["feature", "value"], "left_anti")
    return found.unionByName(outside.groupBy("feature").agg(
        F.lit("unexpected_value").alias("kind"), F.sum("n").alias("n")).select("feature", "kind", "n"))


def unexpected_values(df: DataFrame, feature: str, domain: DataFrame) -> DataFrame:
    """(value, n) outside a domain that is itself a table of values."""
    return value_counts_long(df, [feature]).join(domain.select("value").distinct(), "value", "left_anti").select("value", "n")


# ------------------------------------------------------------------- records


@dataclass(frozen=True)
class RecordSpec:
    """Required fields of an inference record and their types ('int', 'double', 'string')."""

    fields: tuple[tuple[str, str], ...]

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.fields)


# The 12 inputs of the cover-type service and the 17 of the encounter service.
COVER_RECORD = RecordSpec((
    ("Elevation", "double"), ("Aspect", "double"), ("Slope", "double"),
    ("Horizontal_Distance_To_Hydrology", "double"), ("Vertical_Distance_To_Hydrology", "double"),
    ("Horizontal_Distance_To_Roadways", "double"), ("Hillshade_9am", "double"), ("Hillshade_Noon", "double"),
    ("Hillshade_3pm", "double"), ("Horizontal_Distance_To_Fire_Points", "double"),
    ("Wilderness_Area", "int"), ("Soil_Type", "int"),
))
ENCOUNTER_RECORD = RecordSpec(tuple((n, "int") for n in (
    "race", "gender", "age", "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "diabetesMed", "max_glu_serum", "A1Cresult", "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
)))


def _cast_field(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    number = text.try_cast("double")
    if kind == "double":
        return number
    # a whole number, also when written as 3.0
    return F.when(number == F.floor(number), number).try_cast("int")


def parse_records(df: DataFrame, spec: RecordSpec, payload: str = "payload") -> DataFrame:
    """Typed fields and `reason` from JSON text; `reason` is NULL for a valid record.

    Works unchanged on a stream. The first failing field is reported as
    'missing: f' or 'not a <type>: f', text that is no JSON object as 'not an object'.
    """
    raw = F.from_json(q(payload), T.MapType(T.StringType(), T.StringType()))
    parsed = df.withColumn("_raw", raw)
    columns = [_cast_field(F.col("_raw")[n], k).alias(n) for n, k in spec.fields]
    reason = F.when(F.col("_raw").isNull(), F.lit("not an object"))
    for n, k in spec.fields:
        text = F.col("_raw")[n]
        reason = reason.when(text.isNull(), F.lit(f"missing: {n}"))
        reason = reason.when(_cast_field(text, k).isNull(), F.lit(f"not a {k}: {n}"))
    kept = [q(c) for c in df.columns]
    return parsed.select(*kept, *columns, reason.alias("reason"))


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without `reason`, rejected rows with it)."""
    return parsed.filter(F.col("reason").isNull()).drop("reason"), parsed.filter(F.col("reason").isNotNull())
