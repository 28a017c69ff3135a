"""Continuous scoring with a prediction log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.cleaning import q
from millrace.operators.training import score
from millrace.operators.validating import RecordSpec, parse_records, split_valid


def prediction_log(
    scored: DataFrame, key: str, model_name: str, inputs: tuple[str, ...], predicted: str = "predicted"
) -> DataFrame:
    """(id, model_name, feature_1 .. feature_n, label) rows to append; inputs keep their types."""
    return scored.select(
        q(key).cast("bigint").alias("id"),
        F.lit(model_name).alias("model_name"),
        *[q(c).alias(f"feature_{i}") for i, c in enumerate(inputs, 1)],
        q(predicted).cast("string").alias("label"),
    )


def score_records(
    records: DataFrame, spec: RecordSpec, model: PipelineModel, key: str, model_name: str,
    classes: Mapping[int, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(prediction log rows, rejected rows) of JSON records; batch or stream.

    The model is loaded once by the caller, not per record.
    """
    valid, rejected = split_valid(parse_records(records, spec))
    return prediction_log(score(model, valid, classes), key, model_name, spec.names), rejected


def score_stream(
    records: DataFrame, spec: RecordSpec, model: PipelineModel, key: str, model_name: str,
    log_path: str, rejected_path: str, checkpoint: str, classes: Mapping[int, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Score arriving records; predictions and rejects go to two tables.

    Without `every` the query ends with what has arrived; with it (say '30 seconds') it goes on.

    Each micro-batch overwrites its own `batch_id` folder in both tables, so a retried
    batch leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = score_records(batch, spec, model, key, model_name, classes)
            good.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
