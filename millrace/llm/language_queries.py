"""Queries that tell the language of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.language import identify_languages
from millrace.llm.queries import query, table


@query("op11_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
