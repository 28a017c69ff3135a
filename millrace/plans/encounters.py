"""Hospital encounters: raw rows to split, features, balanced training, promotion.

Only three things are stored on the way: raw rows, processed rows, metrics.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import cleaning, coding
from millrace.functions.cleaning import q
from millrace.operators import encoding, sampling, training
from millrace.operators.registry import PRODUCTION
from millrace.spec import ENCOUNTER_SPEC, ENCOUNTER_UNINFORMATIVE, FeatureSpec

POSITIVE = ("<30", ">30")
POSITIVE_STRICT = ("<30",)
TARGET = "target"


def clean_raw(df: DataFrame) -> DataFrame:
    """Reserved and dashed names replaced, the missing marker turned into NULL."""
    return cleaning.null_tokens(cleaning.rename(df, {"change": "change_column"}, dash_to_underscore=True))


def prepare(
    df: DataFrame, spec: FeatureSpec = ENCOUNTER_SPEC, positive: Sequence[str] = POSITIVE, case_sensitive: bool = False
) -> DataFrame:
    """Present features, coerced and filled, with the binary target and the row key."""
    spec = spec.present_in(df.columns, case_sensitive)
    target = cleaning.binary_label(q(spec.label), positive).alias(TARGET)
    cells = [cleaning.to_number(q(c).cast("string")).alias(c) for c in spec.numeric]
    cells += [q(c).cast("string").alias(c) for c in spec.categorical]
    out = df.select(q(spec.key), *cells, target)
    return cleaning.fill_groups(out, [(spec.categorical, "Unknown"), (spec.numeric, 0.0)])


def explore(df: DataFrame) -> DataFrame:
    """The notebook variant: grouped codes, diagnosis buckets, utilisation sum, strict label."""
    out = df.drop(*ENCOUNTER_UNINFORMATIVE)
    groups = {
        "admission_source_id": coding.ADMISSION_SOURCE_GROUPS,
        "admission_type_id": coding.ADMISSION_TYPE_GROUPS,
        "discharge_disposition_id": coding.DISCHARGE_GROUPS,
    }
    for name, mapping in groups.items():
        out = out.withColumn(name, coding.remap(q(name), mapping))
    text = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string" and f.name not in ("readmitted", "diag_1")]
    out = cleaning.fill_groups(out.withColumn("diag_1", coding.bucket_ranges(q("diag_1"))), [(text, "?")])
    return out.withColumn(
        "service_utilization",
        cleaning.total_of(q("number_outpatient"), q("number_emergency"), q("number_inpatient")),
    ).withColumn(TARGET, cleaning.binary_label(q("readmitted"), POSITIVE_STRICT))


@dataclass(frozen=True)
class Processed:
    """All rows with `split`, numbered features and target, and the transformer behind them."""

    rows: DataFrame
    transformer: encoding.ColumnTransformer
    key: str

    @property
    def features(self) -> list[str]:
        return [c for c in self.rows.columns if c.startswith("feature_")]

    def part(self, split: str) -> DataFrame:
        return self.rows.filter(F.col("split") == split)

    def store(self, path: str) -> Processed:
        """The same over a written table, one folder per split, so that a part is read alone."""
        spark = self.rows.sparkSession
        self.rows.write.mode("overwrite").partitionBy("split").parquet(path)
        return replace(self, rows=spark.read.schema(self.rows.schema).parquet(path).select(*self.rows.columns))


def process(
    prepared: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str],
    split: str = "split", target: str = TARGET, per_split: bool = False,
) -> Processed:
    """Features fitted on the training part and applied to all parts.

    `per_split` refits on every part instead, as separate runs per table would.
    """
    keep = [key, split, target]

    def finish(df: DataFrame) -> DataFrame:
        names = [c for c in df.columns if c.startswith("feature_")]
        return df.select(*[q(c) for c in keep], *[cleaning.infinite_to_zero(q(c)).alias(c) for c in names])

    train = prepared.filter(q(split) == "train")
    fitted = encoding.ColumnTransformer.fit(train, numeric, categorical)
    if not per_split:
        return Processed(finish(fitted.transform(prepared, keep)), fitted, key)
    out = fitted.transform(train, keep)
    for name in ("validation", "test"):
        part = prepared.filter(q(split) == name)
        out = out.unionByName(encoding.fit_transform(part, numeric, categorical, keep))
    return Processed(finish(out), fitted, key)


def train(processed: Processed, sample: int | None = None, strategy: str | float = "auto", components: int = 64) -> PipelineModel:
    """Undersample the training part, optionally draw a sample, fit the RBF SVM."""
    rows = sampling.undersample(processed.part("train"), processed.key, TARGET, strategy)
    if sample is not None:
        rows = sampling.sample_rows(rows, processed.key, sample)
    labelled = rows.withColumn(training.LABEL, (q(TARGET) == "YES").cast("double"))
    return training.train_rbf_svm(labelled, processed.features, components=components)


def measure(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    """The five metrics of a model on processed rows, positive class YES."""
    labelled = rows.withColumn(training.LABEL, (q(TARGET) == "YES").cast("int"))
    return training.evaluate(training.score_probability(model, labelled), training.LABEL)


def should_promote(latest: dict[str, float], production: dict[str, float] | None, metric: str = "recall") -> str | None:
    """The stage of the newest version: Production when it is at least as good or alone."""
    return PRODUCTION if production is None or latest[metric] >= production[metric] else None
