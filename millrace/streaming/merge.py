"""Streaming aggregates in update mode: every batch hands on the rows that changed, and readers merge them by key.

A batch is written to a folder named after its number, which a repeated batch overwrites, so repeats change
nothing. The newest row of each key counts. Windows that the watermark has passed leave the state; their last
rows stay in the folders. `compact` folds all but the newest batches into one folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millrace.functions.cleaning import q

BATCH = "_batch"


def write_batch(batch: DataFrame, number: int, target: str) -> None:
    batch.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")


def write_updates(df: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Start writing the changed rows of a streaming aggregate until the present data is read."""
    writer = df.writeStream.outputMode("update").option("checkpointLocation", progress).trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, number: write_batch(batch, number, target)).start()


def read_merged(spark: SparkSession, like: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """The newest row of each key; columns and types are those of `like`."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    rows = spark.read.schema(f"{schema}, {BATCH} bigint").parquet(target)
    rest = [c for c in like.columns if c not in keys]
    newest = rows.groupBy(*[q(c) for c in keys]).agg(F.max_by(F.struct(*[q(c) for c in rest]), F.col(BATCH)).alias("_row"))
    return newest.select(*[q(c) for c in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(*[q(c) for c in like.columns])


def compact(spark: SparkSession, like: DataFrame, keys: Sequence[str], target: str, into: str) -> None:
    """Write the merged rows to a new target as batch -1, which any later batch of the stream takes precedence over."""
    write_batch(read_merged(spark, like, keys, target), -1, into)
