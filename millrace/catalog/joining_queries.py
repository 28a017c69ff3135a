"""Stacking, joining and comparing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import ORDER_LABEL, labelled_orders, query, rounded, table
from millrace.operators import combining, evaluating, sampling


@query("union_outer_cols", """
    SELECT c_acctbal, c_mktsegment, NULL AS o_totalprice FROM customer
    UNION ALL SELECT NULL, NULL, o_totalprice FROM orders""")
def union_outer_cols(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select("c_acctbal", "c_mktsegment")
    return combining.stack_rows(left, table(spark, sf_dir, "orders").select("o_totalprice"))


@query("concat_columns", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def concat_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    left, right = orders.select("o_orderkey", "o_orderpriority"), orders.select("o_orderkey", "o_totalprice")
    return combining.beside(left, right, "o_orderkey")


@query("missing_groups", """
    SELECT c_custkey AS group_number FROM customer WHERE c_custkey NOT IN
        (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000)""")
def missing_groups(spark, sf_dir):
    requested = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("group_number"))
    landed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 400000")
    return combining.failed_groups(requested, landed.select(F.col("o_custkey").alias("group_number")), "group_number")


@query("metric_compare", f"""
    WITH scored AS (SELECT {ORDER_LABEL} AS target, CASE WHEN o_totalprice > 150000 THEN 'YES' ELSE 'NO' END AS predicted,
            CAST('0x' || substr(md5(concat_ws(':', '42', o_orderkey)), 1, 8) AS BIGINT) % 3 < 2 AS part FROM orders),
        counted AS (SELECT part, count(CASE WHEN target = 'YES' AND predicted = 'YES' THEN 1 END) AS tp,
            count(CASE WHEN target = 'NO' AND predicted = 'YES' THEN 1 END) AS fp,
            count(CASE WHEN target = 'YES' AND predicted = 'NO' THEN 1 END) AS fn,
            count(CASE WHEN target = predicted THEN 1 END) AS hits, count(*) AS n FROM scored GROUP BY part),
        long AS (SELECT part, 'accuracy' AS metric, hits / n AS value FROM counted
            UNION ALL SELECT part, 'precision', tp / (tp + fp) FROM counted
            UNION ALL SELECT part, 'recall', tp / (tp + fn) FROM counted
            UNION ALL SELECT part, 'f1_score', 2 * tp / (2 * tp + fp + fn) FROM counted)
    SELECT a.metric, round(a.value, 6) AS validation, round(b.value, 6) AS test
    FROM long a JOIN long b ON a.metric = b.metric AND a.part AND NOT b.part""")
def metric_compare(spark, sf_dir):
    scored = labelled_orders(spark, sf_dir).withColumn(
        "predicted", F.when(F.col("o_totalprice") > 150000, "YES").otherwise("NO")
    ).withColumn("part", sampling.hash_split("o_orderkey", 42))
    names = ["accuracy", "precision", "recall", "f1_score"]
    long = [
        combining.to_long(evaluating.binary_metrics(scored.filter(F.col("part") == part), "target", "predicted"), names)
        for part in ("train", "eval")
    ]
    both = combining.compare_metrics(*long)
    return both.select("metric", rounded("validation").alias("validation"), rounded("test").alias("test"))
