"""Streams over whole tables, run until the present data is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query, rounded, table
from millrace.catalog.model_queries import CLASSES, INPUTS, NAMED, rule_orders
from millrace.operators import training, validating
from millrace.session import scratch_path
from millrace.sources import batches
from millrace.streaming import ingest, merge, scoring, throttle, traffic

BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)


def stream_of(spark, sf_dir, name):
    """A table read as a stream of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def drain(spark, df, label):
    """Run the stream over the present data and read its output table; the file sink commits each batch once."""
    target, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-progress")
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.format("parquet").option("path", target).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(target)


def drain_updates(spark, df, keys, label):
    """The same for an aggregate whose groups change with every batch."""
    target = scratch_path(spark, label)
    merge.write_updates(df, target, scratch_path(spark, f"{label}-progress")).awaitTermination()
    return merge.read_merged(spark, df, keys, target)


@query("stream_ingest", """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderkey // 1000 AS INTEGER) AS batch_number FROM orders""")
def stream_ingest(spark, sf_dir):
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    source, target, progress = (scratch_path(spark, f"ingest-{part}") for part in ("source", "target", "progress"))
    batches.to_positional(table(spark, sf_dir, "orders"), names, F.expr("o_orderkey div 1000")).write.json(source)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    ingest.ingest(spark, source, target, progress, names, types).awaitTermination()
    return spark.read.parquet(target)


@query("stream_throttle", """
    WITH RECURSIVE seconds AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, CAST(floor(epoch(ts)) AS BIGINT) AS at_second,
            event_type = 'signup' AS is_reset FROM events),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY at_second, is_reset) AS i FROM seconds),
        walk AS (
            SELECT key, at_second, is_reset, i, CASE WHEN is_reset THEN 0 ELSE at_second END AS last, CASE WHEN is_reset THEN -1 ELSE 1 END AS n,
                NOT is_reset AS advanced FROM numbered WHERE i = 1
            UNION ALL
            SELECT s.key, s.at_second, s.is_reset, s.i,
                CASE WHEN s.is_reset THEN 0 WHEN w.n < 10 AND s.at_second - w.last > 60 THEN s.at_second ELSE w.last END,
                CASE WHEN s.is_reset THEN -1 WHEN w.n < 10 AND s.at_second - w.last > 60 THEN CASE w.n WHEN -1 THEN 1 ELSE w.n + 1 END ELSE w.n END,
                NOT s.is_reset AND w.n < 10 AND s.at_second - w.last > 60
            FROM walk w JOIN numbered s ON s.key = w.key AND s.i = w.i + 1)
    SELECT key, at_second, is_reset, CAST(n AS INTEGER) AS batch_number, advanced FROM walk""")
def stream_throttle(spark, sf_dir):
    counted = throttle.throttle(stream_of(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "signup")
    return drain(spark, counted, "throttle")


@query("stream_request_rate", """
    SELECT CAST(floor(epoch(ts) / 10) * 10 AS BIGINT) AS window_start, event_type, count(*) AS n_requests, count(*) / 10.0::DOUBLE AS rate
    FROM events GROUP BY 1, 2""")
def stream_request_rate(spark, sf_dir):
    rates = traffic.request_rate(stream_of(spark, sf_dir, "events"), "ts", ["event_type"])
    rates = drain_updates(spark, rates, ["window_start", "event_type"], "rate")
    return rates.withColumn("window_start", F.unix_timestamp("window_start"))


@query("request_rate", """
    SELECT CAST(floor(epoch(ts) / 10) * 10 AS BIGINT) AS window_start, count(*) AS n_requests, count(*) / 10.0::DOUBLE AS rate
    FROM events GROUP BY 1""")
def request_rate(spark, sf_dir):
    rates = traffic.request_rate(table(spark, sf_dir, "events"), "ts")
    return rates.withColumn("window_start", F.unix_timestamp("window_start"))


def _buckets_sql(key: str, source: str) -> str:
    return " UNION ALL ".join(
        [f"SELECT {key}, '{b:g}' AS le, count(CASE WHEN value <= {b} THEN 1 END) AS n FROM {source} GROUP BY ALL" for b in BOUNDS]
        + [f"SELECT {key}, '+Inf', count(value) FROM {source} GROUP BY ALL"]
    )


@query("latency_histogram", _buckets_sql("event_type", "events"))
def latency_histogram(spark, sf_dir):
    wide = traffic.latency_histogram(table(spark, sf_dir, "events"), "value", by=["event_type"], bounds=BOUNDS)
    return traffic.histogram_long(wide, ["event_type"], BOUNDS)


@query("latency_totals", "SELECT event_type, count(*) AS n_values, round(sum(value), 2) + 0.0 AS total FROM events GROUP BY event_type")
def latency_totals(spark, sf_dir):
    wide = traffic.latency_histogram(table(spark, sf_dir, "events"), "value", by=["event_type"], bounds=BOUNDS)
    return wide.select("event_type", "n_values", rounded("total", 2).alias("total"))


@query("stream_latency", _buckets_sql("CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS window_start", "events"))
def stream_latency(spark, sf_dir):
    wide = traffic.latency_histogram(stream_of(spark, sf_dir, "events"), "value", "ts", 3600, bounds=BOUNDS)
    long = traffic.histogram_long(drain_updates(spark, wide, ["window_start"], "latency"), ["window_start"], BOUNDS)
    return long.withColumn("window_start", F.unix_timestamp("window_start"))


@query("outcome_summary", """
    SELECT event_type AS status, count(*) AS n, round(avg(value), 4) + 0.0 AS mean_duration, max(value) AS max_duration,
        round(quantile_cont(value, 0.95), 4) + 0.0 AS p95_duration FROM events GROUP BY event_type""")
def outcome_summary(spark, sf_dir):
    out = traffic.outcome_summary(table(spark, sf_dir, "events"), "event_type", "value")
    return out.withColumns({c: rounded(c, 4) for c in ("mean_duration", "p95_duration")})


@query("outcome_by_user", """
    SELECT CAST(user_id AS VARCHAR) AS status, count(*) AS n, round(quantile_cont(value, 0.95), 4) + 0.0 AS p95_duration
    FROM events GROUP BY user_id""")
def outcome_by_user(spark, sf_dir):
    """As many groups as users."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("user"), "value")
    out = traffic.outcome_summary(rows, "user", "value")
    return out.select("status", "n", rounded("p95_duration", 4).alias("p95_duration"))


@query("stream_score", f"""
    SELECT o_orderkey AS id, 'forest' AS model_name, CASE WHEN o_orderstatus <> 'F' THEN {NAMED} END AS label,
        CASE WHEN o_orderstatus = 'F' THEN 'missing: year' END AS reason FROM orders""")
def stream_score(spark, sf_dir):
    rows = rule_orders(spark, sf_dir)
    spec = validating.RecordSpec(tuple((c, "int") for c in INPUTS))
    source, log, rejected, progress = (scratch_path(spark, f"score-{p}") for p in ("source", "log", "rejected", "progress"))
    # orders of status F lack a field and must be rejected
    status = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    year = F.when(F.col("o_orderstatus") != "F", F.col("year"))
    payload = F.to_json(F.struct("code", year.alias("year")))
    records = rows.join(status, "o_orderkey").select(F.col("o_orderkey").alias("id"), payload.alias("payload"))
    records.repartition(12, "id").write.json(source)
    model = training.train_forest(rows, INPUTS)
    arriving = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 4).json(source)
    scoring.score_stream(arriving, spec, model, "id", "forest", log, rejected, progress, CLASSES).awaitTermination()
    good = spark.read.parquet(log).select("id", "model_name", "label", F.lit(None).cast("string").alias("reason"))
    bad = spark.read.parquet(rejected).select("id", F.lit("forest").alias("model_name"), F.lit(None).cast("string").alias("label"), "reason")
    return good.unionByName(bad)
