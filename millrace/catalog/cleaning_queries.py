"""Projection, filter, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import query, rounded, table
from millrace.functions import cleaning, coding
from millrace.operators import profiling


@query("select_present", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def select_present(spark, sf_dir):
    names = ["o_orderkey", "O_CUSTKEY", "no_such_column", "o_totalprice", "o_orderpriority"]
    return cleaning.select_present(table(spark, sf_dir, "orders"), names)


@query("drop_cols", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_cols(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_mktsegment", "c_name", "no_such_column")


@query("rename_features", """
    SELECT l_orderkey, l_quantity AS feature_0, l_extendedprice AS feature_1, l_linenumber AS change_column FROM lineitem""")
def rename_features(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("l-orderkey"), "l_quantity", "l_extendedprice", F.col("l_linenumber").alias("change")
    )
    renamed = cleaning.rename(rows, {"change": "change_column"}, dash_to_underscore=True)
    return cleaning.enumerate_features(renamed, ["l_quantity", "l_extendedprice"])


GAPS = """gaps AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority,
        CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_totalprice END AS price,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer FROM orders)"""


def gaps(spark, sf_dir):
    """Orders with NULL text, NaN prices and NULL integers."""
    col = F.col
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(col("o_orderpriority") != "5-LOW", col("o_orderpriority")).alias("priority"),
        F.when(col("o_totalprice") < 50000, F.lit(float("nan"))).otherwise(col("o_totalprice")).alias("price"),
        F.when(col("o_orderstatus") != "P", col("o_custkey")).alias("customer"),
    )


@query("dropna_any", f"WITH {GAPS} SELECT * FROM gaps WHERE priority IS NOT NULL AND price IS NOT NULL AND customer IS NOT NULL")
def dropna_any(spark, sf_dir):
    return cleaning.drop_missing(gaps(spark, sf_dir))


@query("filter_sentinel", f"WITH {GAPS} SELECT o_orderkey, priority FROM gaps WHERE priority IS DISTINCT FROM '1-URGENT'")
def filter_sentinel(spark, sf_dir):
    rows = cleaning.drop_sentinel(gaps(spark, sf_dir).select("o_orderkey", "priority"), "priority", "1-URGENT")
    return cleaning.drop_sentinel(rows, "no_such_column", ".")


@query("null_sentinel", """
    SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS p_brand, p_type, p_size FROM part""")
def null_sentinel(spark, sf_dir):
    marked = F.when(F.col("p_size") % 7 == 0, "?").otherwise(F.col("p_brand"))
    return cleaning.null_tokens(table(spark, sf_dir, "part").select("p_partkey", marked.alias("p_brand"), "p_type", "p_size"))


@query("fillna_groups", f"""
    WITH {GAPS} SELECT o_orderkey, coalesce(priority, 'Unknown') AS priority, coalesce(price, 0.0) AS price,
        coalesce(customer, 0) AS customer FROM gaps""")
def fillna_groups(spark, sf_dir):
    return cleaning.fill_groups(gaps(spark, sf_dir), [(["priority"], "Unknown"), (["price", "customer"], 0)])


@query("to_numeric", """
    SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'V' ELSE '' END || o_custkey ||
        CASE WHEN o_orderstatus = 'F' THEN '.83' ELSE '' END AS DOUBLE) AS code FROM orders""")
def to_numeric(spark, sf_dir):
    status = F.col("o_orderstatus")
    text = F.concat(
        F.when(status == "P", "V").otherwise(""), F.col("o_custkey").cast("string"), F.when(status == "F", ".83").otherwise("")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.to_number(text).alias("code"))


@query("inf_to_zero", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS price FROM orders")
def inf_to_zero(spark, sf_dir):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    odd = (
        F.when((status == "F") & (price > 250000), F.lit(float("inf")))
        .when(status == "F", F.lit(float("-inf")))
        .when((status == "P") & (price > 250000), F.lit(float("nan")))
        .when(status == "O", price)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.infinite_to_zero(odd).alias("price"))


@query("clip_bounds", """
    SELECT c_custkey, least(greatest(c_acctbal * 1e7, -1e10), 1e10) AS large, c_acctbal AS small FROM customer""")
def clip_bounds(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") * 1e7).alias("large"), F.col("c_acctbal").alias("small")
    )
    return cleaning.clip_large(rows, ["large", "small"])[0]


@query("clip_missing", """
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN NULL
        ELSE least(greatest(c_acctbal * 1e7, -1e10), 1e10) END AS large FROM customer""")
def clip_missing(spark, sf_dir):
    """NaN and NULL are neither clipped nor do they hide the largest value."""
    part = F.col("c_custkey") % 5
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(part == 0, F.lit(float("nan"))).when(part != 1, F.col("c_acctbal") * 1e7).alias("large"))
    return cleaning.clip_large(rows, ["large"])[0]


@query("max_abs", "SELECT max(abs(c_acctbal)) AS c_acctbal, max(abs(c_nationkey)) AS c_nationkey FROM customer")
def max_abs(spark, sf_dir):
    return cleaning.max_abs(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


@query("cast_schema", """
    SELECT CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
        CAST(l_partkey AS VARCHAR) AS l_partkey FROM lineitem""")
def cast_schema(spark, sf_dir):
    declared = T.StructType([
        T.StructField("l_quantity", T.IntegerType()), T.StructField("l_linenumber", T.DoubleType()),
        T.StructField("l_partkey", T.StringType()),
    ])
    return cleaning.cast_to(table(spark, sf_dir, "lineitem"), declared)


@query("label_binary", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'YES' ELSE 'NO' END AS target FROM orders")
def label_binary(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", cleaning.binary_label(F.col("o_orderstatus"), ("F", "P")).alias("target")
    )


@query("label_binary_strict", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'YES' ELSE 'NO' END AS target FROM orders")
def label_binary_strict(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", cleaning.binary_label(F.col("o_orderstatus"), ("F",)).alias("target")
    )


@query("remap_values", """
    SELECT c_custkey,
        CASE WHEN c_nationkey IN (2, 3) THEN 1 WHEN c_nationkey IN (5, 6, 8, 10, 18, 22, 25, 26) THEN 4
            WHEN c_nationkey IN (15, 17, 20, 21) THEN 9 WHEN c_nationkey IN (13, 14, 23, 24) THEN 11
            ELSE c_nationkey END AS source_group,
        CASE WHEN c_nationkey IN (2, 4, 7) THEN 1 WHEN c_nationkey IN (6, 8) THEN 5 ELSE c_nationkey END AS type_group,
        CASE WHEN c_nationkey IN (6, 8, 13, 19, 20) THEN 1 WHEN c_nationkey IN (3, 4, 5, 9, 10, 12, 14, 22, 23, 24) THEN 2
            WHEN c_nationkey IN (16, 17, 27, 28, 29, 30) THEN 15 WHEN c_nationkey IN (25, 26) THEN 18
            ELSE c_nationkey END AS discharge_group
    FROM customer""")
def remap_values(spark, sf_dir):
    code = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        coding.remap(code, coding.ADMISSION_SOURCE_GROUPS).alias("source_group"),
        coding.remap(code, coding.ADMISSION_TYPE_GROUPS).alias("type_group"),
        coding.remap(code, coding.DISCHARGE_GROUPS).alias("discharge_group"),
    )


@query("bucket_ranges", """
    WITH codes AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'V27'
            WHEN l_returnflag = 'A' THEN (l_partkey % 1100) || '.83' ELSE CAST(l_partkey % 1100 AS VARCHAR) END AS code FROM lineitem),
        cut AS (SELECT *, CAST(trunc(TRY_CAST(code AS DOUBLE)) AS INTEGER) AS c FROM codes)
    SELECT l_orderkey, l_linenumber, code, CASE WHEN c IS NULL THEN 0
        WHEN c BETWEEN 390 AND 459 OR c = 785 THEN 1 WHEN c BETWEEN 460 AND 519 OR c = 786 THEN 2
        WHEN c BETWEEN 520 AND 579 OR c = 787 THEN 3 WHEN c = 250 THEN 4 WHEN c BETWEEN 800 AND 999 THEN 5
        WHEN c BETWEEN 710 AND 739 THEN 6 WHEN c BETWEEN 580 AND 629 OR c = 788 THEN 7
        WHEN c BETWEEN 140 AND 239 THEN 8 ELSE 0 END AS bucket FROM cut""")
def bucket_ranges(spark, sf_dir):
    flag, number = F.col("l_returnflag"), (F.col("l_partkey") % 1100).cast("string")
    code = F.when((flag == "R") & (F.col("l_linenumber") == 1), "V27").when(flag == "A", F.concat(number, F.lit(".83"))).otherwise(number)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", code.alias("code"))
    return rows.withColumn("bucket", coding.bucket_ranges(F.col("code")))


@query("derive_sum", """
    SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber + CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END
        AS utilization FROM lineitem""")
def derive_sum(spark, sf_dir):
    third = F.when(F.col("l_returnflag") != "R", F.col("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", cleaning.total_of(F.col("l_quantity"), F.col("l_linenumber"), third).alias("utilization")
    )


@query("null_audit", f"""
    WITH {GAPS}, counted AS (
        SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS n_missing FROM gaps
        UNION ALL SELECT 'priority', count(*) - count(priority) FROM gaps
        UNION ALL SELECT 'price', count(*) - count(price) FROM gaps
        UNION ALL SELECT 'customer', count(*) - count(customer) FROM gaps)
    SELECT "column", n_missing, n_missing > 0 AS any_missing FROM counted""")
def null_audit(spark, sf_dir):
    return cleaning.missing_counts(gaps(spark, sf_dir))


@query("batch_column", "SELECT o_orderkey, 3 AS batch_number FROM orders")
def batch_column(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lit(3).alias("batch_number"))


def _marked(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_totalprice") < 1100, "tiny").otherwise("usual").alias("size_class")
    )


@query("dominant_share", """
    WITH marked AS (SELECT o_orderstatus, CASE WHEN o_totalprice < 1100 THEN 'tiny' ELSE 'usual' END AS size_class FROM orders),
        counts AS (SELECT 'o_orderstatus' AS "column", count(*) AS n FROM marked GROUP BY o_orderstatus
            UNION ALL SELECT 'size_class', count(*) FROM marked GROUP BY size_class)
    SELECT "column", round(max(n) / sum(n), 6) AS share FROM counts GROUP BY "column" """)
def dominant_share(spark, sf_dir):
    shares = profiling.dominant_share(_marked(spark, sf_dir), ["o_orderstatus", "size_class"])
    return shares.select("column", rounded("share").alias("share"))


@query("drop_dominant", "SELECT o_orderkey, o_orderstatus FROM orders")
def drop_dominant(spark, sf_dir):
    return profiling.drop_dominated(_marked(spark, sf_dir), ["o_orderstatus", "size_class"], 0.99)
