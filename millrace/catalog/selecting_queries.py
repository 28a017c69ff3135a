"""Feature scores and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query, rounded, table
from millrace.operators import combining, encoding, selecting

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ANOVA = """
    long AS (SELECT l_returnflag AS k, 0 AS position, 'l_quantity' AS feature, l_quantity AS x FROM lineitem
        UNION ALL SELECT l_returnflag, 1, 'l_extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT l_returnflag, 2, 'l_discount', l_discount FROM lineitem
        UNION ALL SELECT l_returnflag, 3, 'l_tax', l_tax FROM lineitem),
    whole AS (SELECT feature, avg(x) AS m, count(*) AS n FROM long GROUP BY feature),
    centred AS (SELECT l.feature, position, k, x - m AS x FROM long l JOIN whole USING (feature)),
    per AS (SELECT feature, position, k, count(*) AS nk, sum(x) AS sx, sum(x * x) AS sxx FROM centred GROUP BY ALL),
    sums AS (SELECT feature, position, sum(sxx) - sum(sx) * sum(sx) / sum(nk) AS sst,
        sum(sx * sx / nk) - sum(sx) * sum(sx) / sum(nk) AS ssb, count(*) AS kk, sum(nk) AS n FROM per GROUP BY ALL),
    anova AS (SELECT position, feature, round((ssb / (kk - 1)) / ((sst - ssb) / (n - kk)), 5) AS f_score FROM sums)"""

CHI2 = """
    cells AS (SELECT l_returnflag AS k, 0 AS position, 'l_linestatus' AS feature, l_linestatus AS value FROM lineitem
        UNION ALL SELECT l_returnflag, 1, 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem),
    classes AS (SELECT l_returnflag AS k, count(*) * 1.0 / (SELECT count(*) FROM lineitem) AS share FROM lineitem GROUP BY 1),
    vals AS (SELECT position, feature, value, count(*) AS nv FROM cells GROUP BY ALL),
    seen AS (SELECT feature, value, k, count(*) AS o FROM cells GROUP BY ALL),
    chi2 AS (SELECT position, v.feature, v.value, round(sum((coalesce(o, 0) - share * nv) ** 2 / (share * nv)), 5) AS chi2
        FROM vals v CROSS JOIN classes c LEFT JOIN seen s ON s.feature = v.feature AND s.value = v.value AND s.k = c.k
        GROUP BY position, v.feature, v.value)"""


def _anova(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    scaled = encoding.scale(rows, encoding.fit_numeric(rows, FEATURES), encoding.minmax)
    scores = selecting.anova_scores(scaled, FEATURES, "l_returnflag")
    return scores.withColumn("f_score", rounded("f_score", 5))


def _chi2(spark, sf_dir):
    scores = selecting.chi2_scores(table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_linenumber"], "l_returnflag")
    return scores.withColumn("chi2", rounded("chi2", 5))


@query("anova_f", f"WITH {ANOVA} SELECT feature, f_score FROM anova")
def anova_f(spark, sf_dir):
    return _anova(spark, sf_dir).select("feature", "f_score")


@query("chi2_onehot", f"WITH {CHI2} SELECT feature, value, chi2 FROM chi2")
def chi2_onehot(spark, sf_dir):
    return _chi2(spark, sf_dir).select("feature", "value", "chi2")


@query("retain_report", f"""
    WITH {ANOVA} SELECT feature, row_number() OVER (ORDER BY f_score DESC NULLS LAST, position DESC) <= 2 AS retain FROM anova""")
def retain_report(spark, sf_dir):
    return selecting.retain_report(_anova(spark, sf_dir), "f_score", ["position"], 2).select("feature", "retain")


@query("retain_report_values", f"""
    WITH {CHI2} SELECT feature || '_' || value AS "column",
        row_number() OVER (ORDER BY chi2 DESC NULLS LAST, position DESC, value DESC) <= 5 AS retain FROM chi2""")
def retain_report_values(spark, sf_dir):
    report = selecting.retain_report(_chi2(spark, sf_dir), "chi2", ["position", "value"], 5)
    return report.select(F.concat_ws("_", "feature", "value").alias("column"), "retain")


@query("elbow_scores", f"""
    WITH {ANOVA}, {CHI2}, scores AS (SELECT 'numeric' AS kind, f_score AS score, position, feature AS value FROM anova
        UNION ALL SELECT 'categorical', chi2, position, value FROM chi2),
    ranked AS (SELECT kind, score, row_number() OVER (PARTITION BY kind ORDER BY score DESC) AS rank FROM scores)
    SELECT kind, CAST(rank AS INTEGER) AS rank, score FROM ranked WHERE rank <= CASE kind WHEN 'numeric' THEN 10 ELSE 15 END""")
def elbow_scores(spark, sf_dir):
    numeric = selecting.elbow(_anova(spark, sf_dir), "f_score", ["position"], 10)
    categorical = selecting.elbow(_chi2(spark, sf_dir), "chi2", ["position", "value"], 15)
    return numeric.select(F.lit("numeric").alias("kind"), "rank", F.col("f_score").alias("score")).unionByName(
        categorical.select(F.lit("categorical").alias("kind"), "rank", F.col("chi2").alias("score"))
    )


@query("select_k_best", f"""
    WITH {ANOVA}, chosen AS (SELECT feature FROM anova ORDER BY f_score DESC NULLS LAST, position DESC LIMIT 2)
    SELECT l_orderkey, l_linenumber, feature, x + 0.0 AS value FROM (
        SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
            unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS x FROM lineitem) JOIN chosen USING (feature)""")
def select_k_best(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    best = selecting.select_k_best(table(spark, sf_dir, "lineitem"), FEATURES, "l_returnflag", 2, keys)
    chosen = [c for c in best.columns if c not in keys]
    # long form, because which columns are kept depends on the data
    return best.unpivot(keys, chosen, "feature", "value").withColumn("value", F.col("value") + F.lit(0.0))


@query("select_k_best_values", f"""
    WITH {CHI2}, chosen AS (SELECT feature, value FROM chi2 ORDER BY chi2 DESC NULLS LAST, position DESC, value DESC LIMIT 5)
    SELECT l_orderkey, l_partkey, chosen.feature || '_' || value AS feature,
        CASE WHEN (chosen.feature = 'l_linestatus' AND l_linestatus = value)
            OR (chosen.feature = 'l_linenumber' AND CAST(l_linenumber AS VARCHAR) = value) THEN 1 ELSE 0 END AS cell
    FROM lineitem, chosen""")
def select_k_best_values(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey"]
    best = selecting.select_k_best_values(
        table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_linenumber"], "l_returnflag", 5, keys
    )
    return best.unpivot(keys, [c for c in best.columns if c not in keys], "feature", "cell")


@query("selected_stacked", f"""
    WITH {ANOVA}, {CHI2}, n AS (SELECT feature FROM anova ORDER BY f_score DESC NULLS LAST, position DESC LIMIT 2),
        c AS (SELECT feature, value FROM chi2 ORDER BY chi2 DESC NULLS LAST, position DESC, value DESC LIMIT 3)
    SELECT (SELECT count(*) * 2 FROM lineitem) AS n_rows, (SELECT count(*) FROM n) + (SELECT count(*) FROM c) AS n_columns,
        (SELECT count(*) FROM lineitem JOIN c ON (c.feature = 'l_linestatus' AND c.value = l_linestatus)
            OR (c.feature = 'l_linenumber' AND c.value = CAST(l_linenumber AS VARCHAR))) AS ones""")
def selected_stacked(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    numeric = selecting.select_k_best(rows, FEATURES, "l_returnflag", 2)
    cells = selecting.select_k_best_values(rows, ["l_linestatus", "l_linenumber"], "l_returnflag", 3)
    stacked = combining.stack_rows(numeric, cells)
    ones = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in cells.columns), F.lit(0))
    return stacked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(stacked.columns)).cast("bigint").alias("n_columns"),
        F.sum(ones).alias("ones"),
    )
