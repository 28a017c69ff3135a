"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
repeated passages are cut, sources are mixed to their weights, and the rest is packed.

Every stage takes (spark, docs, sf_dir), where docs has the columns of `documents`, and all
but the last return these columns. `run` writes what a stage returns and reads it again for
the next, so a stage that is repeated after a lost executor starts from files.

Defined cases, besides those of the operators: extra columns are left out; rows with a null
id are never near-duplicates of others here, as no component can be named after them; of
repeated ids the row with the smallest text stays in the near-duplicate stage; a document
whose text is all cut stays as an empty one, and one of which the mix takes no copy goes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.mixing import mix_sources
from millrace.llm.packing import pack_documents
from millrace.llm.simhash import simhash_groups
from millrace.llm.suffix_dedup import remove_repeats
from millrace.llm.toxicity import THRESHOLD, fit_tagger, score_documents
from millrace.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# The ranks of the vocabulary in byte_bpe_50k.json.
RANKS = "byte_bpe_50k.tiktoken"
# The stages are not SQL: a fitted model, hashes, balanced sampling and a tokenizer.
ORACLE_SQL = None


def _unique_ids(docs: DataFrame) -> bool:
    rows, ids = docs.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    return rows == ids


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tagger = fit_tagger(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs.select(*COLUMNS), tagger, keep=COLUMNS[1:])
    return scored.where(F.col("score") < THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    groups = simhash_groups(docs.where("doc_id is not null"))
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi")
    if not _unique_ids(docs):
        rest = [c for c in COLUMNS if c != "doc_id"]
        kept = kept.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", *[f"row.{c}" for c in rest])
    return kept.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = remove_repeats(docs, keep=("lang", "source"), as_text=True)
    return found.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    keyed = docs.withColumn("row", F.col("doc_id")) if _unique_ids(docs) else materialise(
        docs.withColumn("row", F.monotonically_increasing_id()), "keyed")
    copies = mix_sources(keyed, id_col="row").where("copies > 0").select("row", "copies")
    return keyed.join(copies, "row").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
