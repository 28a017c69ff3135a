"""Micro-batch ingest of JSON envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.batches import POSITIONAL_SCHEMA, explode_positional


def stream_envelopes(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """Positional envelopes arriving as JSON lines in a folder."""
    return spark.readStream.schema(POSITIONAL_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def ingest(
    spark: SparkSession, source: str, target: str, checkpoint: str, names: Sequence[str],
    types: dict[str, str] | None = None, files_per_trigger: int = 10, every: str | None = None,
) -> StreamingQuery:
    """Append every arriving batch, with its number, to the table at `target`.

    The parquet file sink commits each batch once, also when a batch is retried. Runs
    until the present files are read, or forever with `every` ('60 seconds').
    """
    rows = explode_positional(stream_envelopes(spark, source, files_per_trigger), names, types)
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
