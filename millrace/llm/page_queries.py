"""Queries over `pages`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.html_extract import extract_text
from millrace.llm.queries import query, table
from millrace.llm.url_filter import ALLOW, BLOCK, judge_urls

# Host, path, verdict.
URL_RULES = (
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
)

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_URL_SQL = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_RULE_ROWS}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
    FROM pages),
parts AS (SELECT page_id,
        translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
verdicts AS (SELECT host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
        max_by(verdict, length(rhost || rpath)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules
        ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN verdicts USING (host, path)
"""


@query("op10_url_filters", _URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op9_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
