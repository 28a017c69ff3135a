"""Constraints, environments, record validation, artifacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query, table
from millrace.operators import registry, validating
from millrace.session import scratch_path

# An expert's corrections to the schema inferred from orders.
CHANGES = {
    "o_custkey": {"int_min": 100, "int_max": 1200},
    "o_orderstatus": {"enum": ("F", "O"), "not_in_env": (validating.SERVING,)},
    "o_orderpriority": {"enum": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")},
}
NAMES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*NAMES)
    return orders, validating.curate(validating.infer_constraints(orders), CHANGES)


@query("infer_constraints", """
    WITH text AS (SELECT 'p_brand' AS feature, list(DISTINCT p_brand ORDER BY p_brand) AS v FROM part
        UNION ALL SELECT 'p_type', list(DISTINCT p_type ORDER BY p_type) FROM part)
    SELECT 'p_partkey' AS feature, 'INT' AS type, 1.0::DOUBLE AS min_fraction, 1::BIGINT AS min_count, NULL AS domain
    UNION ALL SELECT 'p_size', 'INT', NULL, 1, NULL
    UNION ALL SELECT 'p_retailprice', 'FLOAT', 1.0, 1, NULL
    UNION ALL SELECT feature, 'BYTES', 1.0, 1, array_to_string(v, '|') FROM text""")
def infer_constraints(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("p_size"), "p_retailprice", "p_brand", "p_type"
    )
    constraints = validating.constraint_table(spark, validating.infer_constraints(part))
    return constraints.select("feature", "type", "min_fraction", "min_count", F.concat_ws("|", "enum").alias("domain")).withColumn(
        "domain", F.when(F.col("domain") != "", F.col("domain"))
    )


@query("validate_training", """
    WITH bad AS (SELECT 'o_custkey' AS feature, 'out_of_range' AS kind,
            count(CASE WHEN o_custkey < 100 OR o_custkey > 1200 THEN 1 END) AS n FROM orders
        UNION ALL SELECT 'o_orderstatus', 'unexpected_value', count(CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 END) FROM orders
        UNION ALL SELECT 'o_orderpriority', 'low_presence', count(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END) FROM orders
        UNION ALL SELECT 'o_totalprice', 'missing_column', 1
        UNION ALL SELECT 'o_orderkey', 'wrong_type', count(CASE WHEN o_orderstatus = 'P' THEN 1 END) FROM orders
        UNION ALL SELECT 'extra', 'unexpected_column', 1)
    SELECT feature, kind, n FROM bad WHERE n > 0""")
def validate_training(spark, sf_dir):
    orders, constraints = _schema(spark, sf_dir)
    damaged = orders.select(
        F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "P", "x").otherwise("")).alias("o_orderkey"),
        "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit(1).alias("extra"),
    )
    return validating.anomalies(damaged, constraints, validating.TRAINING)


@query("validate_serving", """
    SELECT 'o_custkey' AS feature, 'out_of_range' AS kind, count(*) AS n FROM orders WHERE o_custkey < 100 OR o_custkey > 1200""")
def validate_serving(spark, sf_dir):
    orders, constraints = _schema(spark, sf_dir)
    path = scratch_path(spark, "constraints")
    validating.save_constraints(spark, constraints, path)
    return validating.anomalies(orders.drop("o_orderstatus"), validating.load_constraints(spark, path), validating.SERVING)


@query("validate_long_domain", """
    SELECT 'o_clerk' AS feature, 'unexpected_value' AS kind, count(*) AS n FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) HAVING count(*) > 0""")
def validate_long_domain(spark, sf_dir):
    """A domain of more values than a constraint lists is stored with it, kept when it is saved, and checked."""
    known = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("o_clerk"))
    path = scratch_path(spark, "constraints")
    validating.save_constraints(spark, validating.infer_constraints(known, listed_values=10), path)
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("o_clerk"))
    return validating.anomalies(orders, validating.load_constraints(spark, path))


@query("unexpected_values", """
    SELECT CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey""")
def unexpected_values(spark, sf_dir):
    domain = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("value"))
    return validating.unexpected_values(table(spark, sf_dir, "orders"), "o_custkey", domain)


EVENT_RECORD = validating.RecordSpec((("event_id", "int"), ("user_id", "int"), ("value", "double"), ("event_type", "string")))


def event_payloads(spark, sf_dir):
    """Events as JSON text: errors lack user_id, purchases hold text for a number, views are cut off."""
    kind = F.col("event_type")
    text = F.to_json(F.struct(
        "event_id", F.when(kind != "error", F.col("user_id")).alias("user_id"),
        F.when(kind == "purchase", "n/a").otherwise(F.col("value").cast("string")).alias("value"), "event_type",
    ))
    payload = F.when(kind == "view", F.concat(F.lit("no object "), text)).otherwise(text)
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), payload.alias("payload"))


@query("validate_records", """
    SELECT event_id AS id, CASE event_type WHEN 'error' THEN 'missing: user_id' WHEN 'purchase' THEN 'not a double: value'
        WHEN 'view' THEN 'not an object' END AS reason FROM events""")
def validate_records(spark, sf_dir):
    return validating.parse_records(event_payloads(spark, sf_dir), EVENT_RECORD).select("id", "reason")


@query("valid_records", "SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id, value, event_type "
       "FROM events WHERE event_type IN ('click', 'signup')")
def valid_records(spark, sf_dir):
    valid, _ = validating.split_valid(validating.parse_records(event_payloads(spark, sf_dir), EVENT_RECORD))
    return valid.select(*EVENT_RECORD.names)


def _artifacts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("type"), F.concat_ws("/", "source", "doc_id").alias("uri")
    )


@query("artifacts_by_type", "SELECT doc_id AS id, lang AS type, source || '/' || doc_id AS uri FROM documents WHERE lang = 'en'")
def artifacts_by_type(spark, sf_dir):
    return registry.artifacts_by_type(_artifacts(spark, sf_dir), "en")


@query("artifact_types", "SELECT DISTINCT lang AS type FROM documents")
def artifact_types(spark, sf_dir):
    return registry.artifact_types(_artifacts(spark, sf_dir))
