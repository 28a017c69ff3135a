"""Queries over `embeddings`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.ann import search_neighbours
from millrace.llm.embedding_dedup import near_vectors
from millrace.llm.queries import query, table


@query("op7_embedding_dedup")
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_ann")
def ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
