"""Queries that rank and align `documents`."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.alignment import align_documents
from millrace.llm.lexical import search_ranked
from millrace.llm.queries import query, table

_LEXICAL_SQL = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, total GROUP BY term, big_n),
norms AS (SELECT doc_id, 100 - 25 + (25 * n * big_n) // big_l AS m FROM lengths, total),
scores AS (SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op12_lexical_search", _LEXICAL_SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"))
