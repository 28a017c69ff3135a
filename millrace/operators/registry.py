"""Runs, model versions and promotion as tables.

runs(run_id, ts, params map, metrics map, tags map), versions(name, version, stage, source),
artifacts(id, type, uri).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import q
from millrace.operators.training import save_model
from millrace.sources.tables import append_table

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("params", _TEXT_MAP), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", _TEXT_MAP),
])
PRODUCTION = "Production"


def run_row(
    spark: SparkSession, run_id: str, ts: int, params: dict, metrics: dict, columns: list[str]
) -> DataFrame:
    """One run to append; the tag names the input columns."""
    row = (
        run_id, ts, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()},
        {"columns": ",".join(columns)},
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


VERSION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("stage", T.StringType()), T.StructField("source", T.StringType()), T.StructField("run_id", T.StringType()),
])


def register(
    spark: SparkSession, runs: str, versions: str, models: str, name: str, model: PipelineModel,
    run_id: str, ts: int, params: dict, metrics: dict, columns: list[str],
) -> int:
    """Store a fitted model, append its run and its version, and return the version number.

    One writer for a model name at a time; the number is one above the largest stored.
    """
    stored = _stored(spark, versions, VERSION_SCHEMA).filter(F.col("name") == name)
    version = (stored.agg(F.max("version")).first()[0] or 0) + 1
    source = f"{models.rstrip('/')}/{name}/{version}"
    save_model(model, source)
    append_table(run_row(spark, run_id, ts, params, metrics, columns), runs)
    append_table(spark.createDataFrame([(name, version, "None", source, run_id)], VERSION_SCHEMA), versions)
    return version


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of the registry, empty before the first row is appended."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def promoted(spark: SparkSession, versions: str, runs: str, metric: str = "recall") -> DataFrame:
    """The stored versions with their metric, the latest of each name promoted if it is as good as the one before.

    Versions are judged one after another, as they would have been when they were registered: a version
    is in production if no earlier one is better.
    """
    stored = _stored(spark, versions, VERSION_SCHEMA).join(
        _stored(spark, runs, RUN_SCHEMA).select("run_id", F.col("metrics")[metric].alias(metric)), "run_id")
    before = Window.partitionBy("name").orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    best = F.max(metric).over(before)
    wins = best.isNull() | (F.col(metric) >= best)
    return stored.withColumn("stage", F.when(wins, F.lit(PRODUCTION)).otherwise(F.col("stage")))


def latest_run(runs: DataFrame, by: str | None = None) -> DataFrame:
    """The newest run (per `by`); of equal times the largest run id. A plain aggregate, no sort."""
    newest = F.max_by(F.struct("run_id", "ts", "params", "metrics", "tags"), F.struct("ts", "run_id")).alias("r")
    grouped = runs.groupBy(q(by)) if by else runs.groupBy()
    out = grouped.agg(newest)
    return out.select(*([q(by)] if by else []), "r.*")


def latest_versions(versions: DataFrame) -> DataFrame:
    """(name, version): highest version per model."""
    return versions.groupBy("name").agg(F.max("version").alias("version"))


def list_models(versions: DataFrame) -> DataFrame:
    return versions.select("name", "version", "stage")


def promote(versions: DataFrame, chosen: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """The version table with the chosen (name, version) rows set to `stage`; others unchanged."""
    picked = chosen.select("name", "version").distinct().withColumn("_picked", F.lit(True))
    return (
        versions.join(picked, ["name", "version"], "left")
        .withColumn("stage", F.when(F.col("_picked"), F.lit(stage)).otherwise(F.col("stage")))
        .drop("_picked")
    )


def challengers_to_promote(latest: DataFrame, production: DataFrame, metric: str = "recall") -> DataFrame:
    """(name, version) of the latest models that are at least as good as the one in production.

    A model name without a production version is promoted.
    """
    champion = production.select("name", q(metric).alias("_champion"))
    return (
        latest.select("name", "version", q(metric).alias("_challenger"))
        .join(champion, "name", "left")
        .filter(F.col("_champion").isNull() | (F.col("_challenger") >= F.col("_champion")))
        .select("name", "version")
    )


def artifacts_by_type(artifacts: DataFrame, kind: str) -> DataFrame:
    return artifacts.filter(F.col("type") == kind).select("id", "type", "uri")


def artifact_types(artifacts: DataFrame) -> DataFrame:
    return artifacts.select("type").distinct()
