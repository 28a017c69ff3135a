"""Profiles and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.catalog import LABELLED, THREE_WAY, labelled_orders, query, rounded, table
from millrace.catalog.cleaning_queries import GAPS, gaps
from millrace.operators import profiling, sampling

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _round(df, digits=4):
    kinds = dict(df.dtypes)
    return df.select(*[rounded(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def _describe_sql(names):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) + 0.0 AS mean, round(stddev_samp({c}), 4) + 0.0 AS std,
        round(min({c}), 4) + 0.0 AS min, round(quantile_cont({c}, 0.25), 4) + 0.0 AS p25, round(quantile_cont({c}, 0.5), 4) + 0.0 AS p50,
        round(quantile_cont({c}, 0.75), 4) + 0.0 AS p75, round(max({c}), 4) + 0.0 AS max FROM lineitem"""
        for c in names
    )


@query("describe_numeric", _describe_sql(MEASURES))
def describe_numeric(spark, sf_dir):
    return _round(profiling.describe(table(spark, sf_dir, "lineitem"), MEASURES))


def _corr_sql(names):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a in names for b in names
    )


@query("corr_matrix", _corr_sql(MEASURES))
def corr_matrix(spark, sf_dir):
    return _round(profiling.correlations(table(spark, sf_dir, "lineitem"), MEASURES), 6)


@query("value_counts", """
    SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority
    UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY o_custkey""")
def value_counts(spark, sf_dir):
    return profiling.value_counts(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("class_distribution", f"""
    WITH {LABELLED}, counts AS (SELECT target, count(*) AS n FROM labelled GROUP BY target)
    SELECT 'before' AS stage, target, n FROM counts
    UNION ALL SELECT 'after', target, (SELECT min(n) FROM counts) FROM counts""")
def class_distribution(spark, sf_dir):
    orders = labelled_orders(spark, sf_dir).select("o_orderkey", "target")
    balanced = sampling.undersample(orders, "o_orderkey", "target", "auto")
    stages = [
        profiling.class_distribution(df, "target").select(F.lit(stage).alias("stage"), "target", "n")
        for stage, df in (("before", orders), ("after", balanced))
    ]
    return stages[0].unionByName(stages[1])


@query("table_profile", f"""
    WITH {GAPS}, n AS (SELECT count(*) AS n_rows, 4 AS n_columns FROM gaps)
    SELECT 0 AS position, 'o_orderkey' AS "column", 'bigint' AS dtype, (SELECT count(o_orderkey) FROM gaps) AS non_null, n.* FROM n
    UNION ALL SELECT 1, 'priority', 'string', (SELECT count(priority) FROM gaps), n.* FROM n
    UNION ALL SELECT 2, 'price', 'double', (SELECT count(price) FROM gaps), n.* FROM n
    UNION ALL SELECT 3, 'customer', 'bigint', (SELECT count(customer) FROM gaps), n.* FROM n""")
def table_profile(spark, sf_dir):
    return profiling.table_profile(gaps(spark, sf_dir))


@query("dataset_info", f"""
    WITH {THREE_WAY} SELECT split, count(*) AS n_rows, CAST(ceil(count(*) / 1000) AS BIGINT) AS n_pages FROM parts GROUP BY split""")
def dataset_info(spark, sf_dir):
    orders = labelled_orders(spark, sf_dir).select("o_orderkey", "target")
    return profiling.dataset_info(sampling.three_way_split(orders, "o_orderkey", "target"), "split", 1000)


def _numeric_stats(c, kind):
    return f"""SELECT '{c}' AS feature, '{kind}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_missing,
        round(avg({c}), 4) + 0.0 AS mean, round(stddev_pop({c}), 4) + 0.0 AS std, count(CASE WHEN {c} = 0 THEN 1 END) AS zeros,
        round(CAST(min({c}) AS DOUBLE), 4) + 0.0 AS min, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) + 0.0 AS median,
        round(CAST(max({c}) AS DOUBLE), 4) + 0.0 AS max, CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS VARCHAR) AS top,
        CAST(NULL AS BIGINT) AS top_freq, CAST(NULL AS DOUBLE) AS avg_length FROM gaps"""


@query("feature_stats", f"""
    WITH {GAPS}, tops AS (SELECT priority AS top, count(*) AS top_freq FROM gaps WHERE priority IS NOT NULL GROUP BY priority
        ORDER BY top_freq DESC, top LIMIT 1)
    {_numeric_stats('o_orderkey', 'INT')} UNION ALL {_numeric_stats('price', 'FLOAT')} UNION ALL {_numeric_stats('customer', 'INT')}
    UNION ALL SELECT 'priority', 'BYTES', count(*), count(*) - count(priority), NULL, NULL, NULL, NULL, NULL, NULL,
        count(DISTINCT priority), (SELECT top FROM tops), (SELECT top_freq FROM tops), round(avg(length(priority)), 4) FROM gaps""")
def feature_stats(spark, sf_dir):
    return _round(profiling.feature_stats(gaps(spark, sf_dir)))


def _split_stats(c, kind):
    return _numeric_stats(c, kind).replace("SELECT ", "SELECT CAST(o_orderkey % 3 AS INTEGER) AS split, ", 1) + " GROUP BY 1"


@query("feature_stats_split", f"""
    WITH {GAPS}, counts AS (SELECT o_orderkey % 3 AS split, priority AS top, count(*) AS top_freq FROM gaps WHERE priority IS NOT NULL GROUP BY ALL),
        tops AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY split ORDER BY top_freq DESC, top) = 1)
    {_split_stats('o_orderkey', 'INT')} UNION ALL {_split_stats('price', 'FLOAT')} UNION ALL {_split_stats('customer', 'INT')}
    UNION ALL SELECT CAST(o_orderkey % 3 AS INTEGER), 'priority', 'BYTES', count(*), count(*) - count(priority), NULL, NULL, NULL, NULL, NULL, NULL,
        count(DISTINCT priority), any_value(tops.top), any_value(tops.top_freq), round(avg(length(priority)), 4)
    FROM gaps JOIN tops ON tops.split = o_orderkey % 3 GROUP BY 1""")
def feature_stats_split(spark, sf_dir):
    """Statistics of each of three splits."""
    rows = gaps(spark, sf_dir).withColumn("split", (F.col("o_orderkey") % 3).cast("int"))
    return _round(profiling.feature_stats_by(rows, "split"))


@query("value_histogram", """
    SELECT CAST(least(floor(value / 50), 10) + 1 AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY 1""")
def value_histogram(spark, sf_dir):
    return profiling.histogram(table(spark, sf_dir, "events"), "value", 0.0, 500.0, 10)


# The rare class is one of fifteen groups of customers; balancing must survive the sample that follows.
RARE = "CASE WHEN o_custkey % 15 = 0 THEN 'YES' ELSE 'NO' END"


@query("balanced_sample_size", f"""
    WITH labelled AS (SELECT o_orderkey, {RARE} AS target FROM orders),
        small AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM labelled GROUP BY target)),
        s AS (SELECT least(2 * m, 1000) AS size, m FROM small)
    SELECT target, true AS near_half, true AS all_drawn FROM (SELECT DISTINCT target FROM labelled), s WHERE size > 0""")
def balanced_sample_size(spark, sf_dir):
    """Both classes of a sample drawn after balancing lie within five deviations of half of it."""
    rare = F.when(F.col("o_custkey") % 15 == 0, "YES").otherwise("NO")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", rare.alias("target"))
    balanced = sampling.undersample(orders, "o_orderkey", "target", "auto")
    counts = profiling.class_distribution(sampling.sample_rows(balanced, "o_orderkey", 1000), "target")
    size = F.sum("n").over(Window.partitionBy())
    wanted = F.least(F.lit(1000), F.lit(balanced.count()))
    return counts.select(
        "target", (F.abs(F.col("n") - size / 2) <= 5 * F.sqrt(size / 4)).alias("near_half"), (size == wanted).alias("all_drawn"))
