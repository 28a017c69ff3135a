"""Sources, sinks and table lifecycle: each query writes rows of a table and reads them back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import hash_order, query, rounded, table
from millrace.functions.cleaning import json_records
from millrace.operators import encoding, profiling, sampling
from millrace.session import scratch_path
from millrace.sources import batches, delimited, snapshots, tables

ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType()),
])
PAGE = 1_000


@query("src_csv", """
    SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders""")
def src_csv(spark, sf_dir):
    marked = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", "NA").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    path = scratch_path(spark, "csv")
    delimited.write_csv(marked, path)
    return delimited.read_csv(spark, path, ORDER_SCHEMA)


@query("src_csv_raw", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
    FROM customer""")
def src_csv_raw(spark, sf_dir):
    path = scratch_path(spark, "csv")
    delimited.write_csv(table(spark, sf_dir, "customer"), path, drop=["c_acctbal"])
    return delimited.read_csv_raw(spark, path)


@query("limit_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def limit_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return delimited.first_rows(orders, "o_orderkey", 1000)


@query("src_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_table(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    name, path = f"customer_{uuid4().hex}", scratch_path(spark, "table")
    tables.create_table(spark, name, customer.schema, path)
    customer.write.insertInto(name)
    return tables.read_table(spark, name)


@query("src_json_positional", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
        CAST(o_orderkey // 1000 AS INTEGER) AS batch_number FROM orders""")
def src_json_positional(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "positional")
    batches.to_positional(orders, ORDER_FIELDS, F.expr(f"o_orderkey div {PAGE}")).write.json(path)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return batches.read_positional(spark, path, ORDER_FIELDS, types)


@query("src_json_records", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def src_json_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "records")
    envelopes = batches.to_records(orders, ORDER_FIELDS, F.expr(f"o_orderkey div {PAGE}"), PAGE)
    # both document forms occur: an envelope, or only its list
    document = F.when(F.col("batch_number") % 2 == 0, F.to_json(F.struct(*envelopes.columns))).otherwise(F.to_json("data"))
    envelopes.select(document.alias("value")).write.text(path)
    return batches.read_records(spark, path, ORDER_SCHEMA)


@query("src_json_landing", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 'c_nationkey=' || c_nationkey AS source FROM customer")
def src_json_landing(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "landing")
    batches.land_groups(customer, "c_nationkey", path)
    fields = [f for f in customer.schema.fields if f.name != "c_nationkey"]
    good, _ = batches.read_landing(spark, path, T.StructType(fields))
    folder = F.regexp_extract("source_file", "/(c_nationkey=[^/]+)/", 1)
    return good.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", folder.alias("source"))


@query("stats_transformed", """
    WITH marked AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(concat_ws(':', '42', event_id)), 1, 8) AS BIGINT) % 3 < 2
            THEN 'train' ELSE 'eval' END AS split FROM events),
        fitted AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events),
        vocabulary AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type DESC) - 1 AS idx
            FROM events GROUP BY event_type),
        mapped AS (SELECT split, (value - m) / s AS value, idx FROM marked JOIN vocabulary USING (event_type), fitted)
    SELECT split, count(*) AS n, round(avg(value), 6) + 0.0 AS mean_value, round(min(value), 6) + 0.0 AS min_value,
        round(max(value), 6) + 0.0 AS max_value, round(avg(idx), 6) + 0.0 AS mean_type,
        count(CASE WHEN idx = 0 THEN 1 END) AS zero_types
    FROM mapped GROUP BY split""")
def stats_transformed(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("split", sampling.hash_split("event_id", 42))
    mapped, _ = encoding.run_preprocessing(
        events, lambda a: {"value": a.z_score("value"), "event_type": a.vocabulary("event_type")}, ["split"]
    )
    path = scratch_path(spark, "transformed")
    mapped.write.partitionBy("split").parquet(path)
    stored = spark.read.parquet(path)
    return stored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("value")).alias("mean_value"),
        rounded(F.min("value")).alias("min_value"), rounded(F.max("value")).alias("max_value"),
        rounded(F.avg("event_type")).alias("mean_type"),
        F.count(F.when(F.col("event_type") == 0, 1)).alias("zero_types"),
    )


@query("tbl_create", "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY o_orderstatus")
def tbl_create(spark, sf_dir):
    name, path = f"orders_{uuid4().hex}", scratch_path(spark, "table")
    tables.create_table(spark, name, ORDER_SCHEMA, path)
    tables.create_table(spark, name, ORDER_SCHEMA, path)  # a second call changes nothing
    table(spark, sf_dir, "orders").select(*ORDER_FIELDS).write.insertInto(name)
    counts = tables.read_table(spark, name).groupBy("o_orderstatus")
    return counts.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_customers"))


@query("sink_overwrite", """
    SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) + 0.0 AS total,
        (SELECT count(*) FROM orders) AS written FROM orders GROUP BY o_orderpriority""")
def sink_overwrite(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "replaced")
    tables.replace_table(orders.select("o_orderkey"), path)
    written = tables.replace_table(orders, path, expected=orders.count())
    stored = spark.read.schema(orders.schema).parquet(path)
    return stored.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total"), F.lit(written).cast("bigint").alias("written")
    )


@query("sink_append", "SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS part FROM orders")
def sink_append(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), scratch_path(spark, "appended")
    first = F.col("o_orderstatus") == "F"
    tables.append_table(orders.filter(first).withColumn("part", F.lit(1)), path)
    tables.append_table(orders.filter(~first).withColumn("part", F.lit(2)), path)
    return spark.read.parquet(path)


@query("sink_skip_empty", """
    WITH marked AS (SELECT CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS p_brand,
        CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END AS p_type FROM part)
    SELECT p_brand, p_type FROM marked WHERE p_brand IS NOT NULL OR p_type IS NOT NULL""")
def sink_skip_empty(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 3 == 0, "?").otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") % 2 == 0, "?").otherwise(F.col("p_type")).alias("p_type"),
    )
    path = scratch_path(spark, "kept")
    tables.append_table(tables.skip_empty_rows(part), path)
    return spark.read.parquet(path)


UPSERT_SQL = """
    WITH both_rows AS (SELECT c_custkey AS k, c_acctbal AS amount, CAST(-1 AS BIGINT) AS batch_number FROM customer
        UNION ALL SELECT o_custkey, o_totalprice, o_orderkey FROM orders)
    SELECT k, amount, batch_number FROM both_rows
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY batch_number DESC) = 1"""


def _upsert_input(spark, sf_dir):
    current = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("amount"), F.lit(-1).cast("bigint").alias("batch_number")
    )
    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("batch_number")
    )
    return current, changes


@query("upsert_latest", UPSERT_SQL)
def upsert_latest(spark, sf_dir):
    current, changes = _upsert_input(spark, sf_dir)
    return tables.upsert(current, changes, ["k"])


@query("upsert_stored", UPSERT_SQL)
def upsert_stored(spark, sf_dir):
    current, changes = _upsert_input(spark, sf_dir)
    bucket = F.pmod(F.xxhash64("k"), F.lit(8)).cast("int")
    path = scratch_path(spark, "merged")
    current.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(path)
    tables.upsert_partitions(spark, path, changes.withColumn("bucket", bucket), ["k"], "bucket")
    return spark.read.parquet(path).select("k", "amount", "batch_number")


@query("upsert_snapshot", f"""
    WITH merged AS ({UPSERT_SQL}) SELECT m.k, m.amount, m.batch_number, c.c_acctbal AS first_amount, 2 AS snapshot
    FROM merged m LEFT JOIN customer c ON c.c_custkey = m.k""")
def upsert_snapshot(spark, sf_dir):
    """All rows after the update, beside their amounts in the snapshot before it."""
    current, changes = _upsert_input(spark, sf_dir)
    bucket = F.pmod(F.xxhash64("k"), F.lit(8)).cast("int")
    path = scratch_path(spark, "snapshots")
    first = snapshots.write_table(current.withColumn("bucket", bucket), path, "bucket")
    second = snapshots.upsert_table(spark, path, changes.withColumn("bucket", bucket), ["k"])
    before = snapshots.read_table(spark, path, first).select("k", F.col("amount").alias("first_amount"))
    after = snapshots.read_table(spark, path).select("k", "amount", "batch_number")
    return after.join(before, "k", "left").withColumn("snapshot", F.lit(second))


@query("sink_csv", f"""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    QUALIFY row_number() OVER (ORDER BY {hash_order('sample:7', 'o_orderkey')}) <= (SELECT round_even(count(*) * 0.2, 0) FROM orders)""")
def sink_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*ORDER_FIELDS)
    path = scratch_path(spark, "serving")
    delimited.write_csv(sampling.sample_fraction(orders, "o_orderkey", 0.2, 7), path, drop=["o_orderstatus"])
    kept = T.StructType([f for f in ORDER_SCHEMA.fields if f.name != "o_orderstatus"])
    return delimited.read_csv(spark, path, kept)


@query("to_json_records", """
    SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' ||
        CASE WHEN event_type IN ('error', 'view') THEN 'null' ELSE CAST(value AS VARCHAR) END || '}' AS record FROM events""")
def to_json_records(spark, sf_dir):
    value = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "view", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return json_records(table(spark, sf_dir, "events").select("event_id", "event_type", value.alias("value")))


@query("table_first_rows", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5")
def table_first_rows(spark, sf_dir):
    return profiling.head(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "event_id", 5)
