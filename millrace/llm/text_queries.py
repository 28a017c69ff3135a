"""Queries over `documents` and `conversations`."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chat import format_chats
from millrace.llm.mixing import mix_sources
from millrace.llm.packing import pack_documents
from millrace.llm.queries import query, table
from millrace.llm.simhash import simhash_groups
from millrace.llm.suffix_dedup import remove_repeats
from millrace.llm.toxicity import score_toxicity

# The ranks of the vocabulary in byte_bpe_50k.json.
RANKS = "byte_bpe_50k.tiktoken"


@query("op1_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query("op2_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op4_simhash")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op3_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))
