"""Encoders, scalers and fitted transformations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import THREE_WAY, labelled_orders, query, rounded, table
from millrace.operators import encoding, sampling
from millrace.plans import encounters
from millrace.session import scratch_path

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem(spark, sf_dir, *more):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *more)


@query("encode_label", """
    SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
        CAST(dense_rank() OVER (ORDER BY p_size) - 1 AS INTEGER) AS p_size FROM part""")
def encode_label(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return encoding.encode_labels(part, ["p_brand", "p_size"])[0]


@query("encode_label_long", "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS o_custkey FROM orders")
def encode_label_long(spark, sf_dir):
    return encoding.encode_labels(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])[0]


@query("encode_label_inverse", """
    SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code, p_brand AS decoded FROM part""")
def encode_label_inverse(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    vocabulary = encoding.fit_vocabularies(part, ["p_brand"])["p_brand"]
    coded = encoding.apply_vocabulary(part, vocabulary, "error", "code")
    return encoding.decode(coded.drop("p_brand"), vocabulary, "code", "decoded")


@query("encode_ordinal", """
    WITH known AS (SELECT DISTINCT o_orderpriority AS p, o_orderstatus AS s FROM orders
            WHERE o_orderpriority <> '3-MEDIUM' AND o_orderstatus <> 'O'),
        ps AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS i FROM (SELECT DISTINCT p FROM known)),
        ss AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS i FROM (SELECT DISTINCT s FROM known))
    SELECT o_orderkey, CAST(coalesce(ps.i, -1) AS INTEGER) AS o_orderpriority,
        CAST(coalesce(ss.i, -1) AS INTEGER) AS o_orderstatus
    FROM orders LEFT JOIN ps ON o_orderpriority = p LEFT JOIN ss ON o_orderstatus = s""")
def encode_ordinal(spark, sf_dir):
    names = ["o_orderpriority", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *names)
    known = orders.filter("o_orderpriority <> '3-MEDIUM' AND o_orderstatus <> 'O'")
    vocabularies = encoding.fit_vocabularies(known, names)
    for name in names:
        orders = encoding.apply_vocabulary(orders, vocabularies[name], "minus_one")
    return orders


def _onehot_sql(values: tuple[str, ...]) -> str:
    cells = ", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS \"o_orderpriority_{v}\"" for v in values)
    return f"SELECT o_orderkey, {cells} FROM orders"


@query("encode_onehot", _onehot_sql(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")))
def encode_onehot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return encoding.one_hot(orders, encoding.fit_vocabularies(orders, ["o_orderpriority"]).values())


@query("encode_onehot_ignore", _onehot_sql(("1-URGENT", "2-HIGH", "4-NOT SPECIFIED")))
def encode_onehot_ignore(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    known = orders.filter("o_orderpriority NOT IN ('3-MEDIUM', '5-LOW')")
    return encoding.one_hot(orders, encoding.fit_vocabularies(known, ["o_orderpriority"]).values(), "ignore")


@query("encode_onehot_vector", """
    WITH customers AS (SELECT CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS position, count(*) AS n FROM orders GROUP BY o_custkey),
        priorities AS (SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS position, count(*) AS n
            FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority)
    SELECT position, n FROM customers
    UNION ALL SELECT CAST(position + (SELECT count(*) FROM customers) AS INTEGER), n FROM priorities""")
def encode_onehot_vector(spark, sf_dir):
    """Ones at each place of the vectors of all orders: a place for every customer, then for every known priority."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    known = orders.filter("o_orderpriority <> '5-LOW'")
    vocabularies = [
        encoding.fit_vocabularies(orders, ["o_custkey"])["o_custkey"],
        encoding.fit_vocabularies(known, ["o_orderpriority"])["o_orderpriority"],
    ]
    vectors = encoding.one_hot_vector(orders, vocabularies, "ignore")
    ones = vectors.select(F.explode(encoding.places_of_ones(F.col("features"))).alias("position"))
    return ones.groupBy("position").agg(F.count(F.lit(1)).alias("n"))


def _scaled_sql(center: str, width: str) -> str:
    cells = ", ".join(f"round(({c} - {center.format(c)}) / ({width.format(c)}), 6) + 0.0 AS {c}" for c in MEASURES)
    stats = ", ".join(
        f"min({c}) AS min_{c}, max({c}) AS max_{c}, avg({c}) AS avg_{c}, stddev_pop({c}) AS std_{c}" for c in MEASURES
    )
    return f"WITH fitted AS (SELECT {stats} FROM lineitem) SELECT l_orderkey, l_linenumber, {cells}, 0.0 AS constant FROM lineitem, fitted"


def _scaled(spark, sf_dir, how):
    rows = _lineitem(spark, sf_dir, *MEASURES).withColumn("constant", F.lit(5.0))
    scaled = encoding.scale(rows, encoding.fit_numeric(rows, [*MEASURES, "constant"]), how)
    return scaled.select("l_orderkey", "l_linenumber", *[rounded(c).alias(c) for c in (*MEASURES, "constant")])


@query("scale_minmax", _scaled_sql("min_{0}", "max_{0} - min_{0}").replace("0.0 AS constant", "CAST(0 AS DOUBLE) AS constant"))
def scale_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, encoding.minmax)


@query("scale_standard", _scaled_sql("avg_{0}", "std_{0}").replace("0.0 AS constant", "CAST(0 AS DOUBLE) AS constant"))
def scale_standard(spark, sf_dir):
    return _scaled(spark, sf_dir, encoding.standard)


@query("encode_then_scale", """
    WITH coded AS (SELECT l_orderkey, l_linenumber, l_quantity, dense_rank() OVER (ORDER BY l_returnflag) - 1 AS flag FROM lineitem),
        fitted AS (SELECT min(flag) AS lf, max(flag) AS hf, min(l_quantity) AS lq, max(l_quantity) AS hq FROM coded)
    SELECT l_orderkey, l_linenumber, round((flag - lf) / (hf - lf), 6) + 0.0 AS l_returnflag,
        round((l_quantity - lq) / (hq - lq), 6) + 0.0 AS l_quantity FROM coded, fitted""")
def encode_then_scale(spark, sf_dir):
    rows, _ = encoding.encode_labels(_lineitem(spark, sf_dir, "l_returnflag", "l_quantity"), ["l_returnflag"])
    scaled = encoding.scale(rows, encoding.fit_numeric(rows, ["l_returnflag", "l_quantity"]), encoding.minmax)
    return scaled.select("l_orderkey", "l_linenumber", *[rounded(c).alias(c) for c in ("l_returnflag", "l_quantity")])


@query("scale_zscore", """
    SELECT event_id, round((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events), 6) + 0.0 AS value
    FROM events""")
def scale_zscore(spark, sf_dir):
    scored, _ = encoding.run_preprocessing(
        table(spark, sf_dir, "events"), lambda a: {"value": a.z_score("value")}, ["event_id"]
    )
    return scored.select("event_id", rounded("value").alias("value"))


@query("normalize_l2", """
    WITH n AS (SELECT *, sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber + l_tax * l_tax) AS d FROM lineitem)
    SELECT l_orderkey, round(l_quantity / d, 6) + 0.0 AS l_quantity, round(l_linenumber / d, 6) + 0.0 AS l_linenumber,
        round(l_tax / d, 6) + 0.0 AS l_tax FROM n""")
def normalize_l2(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.col("l_linenumber").cast("double").alias("l_linenumber"), "l_tax")
    names = ["l_quantity", "l_linenumber", "l_tax"]
    return encoding.normalise_rows(rows, names).select("l_orderkey", *[rounded(c).alias(c) for c in names])


@query("encode_vocab", """
    WITH v AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type DESC) - 1 AS i FROM part GROUP BY p_type)
    SELECT p_partkey, CAST(i AS INTEGER) AS p_type FROM part JOIN v USING (p_type)""")
def encode_vocab(spark, sf_dir):
    mapped, _ = encoding.run_preprocessing(
        table(spark, sf_dir, "part"), lambda a: {"p_type": a.vocabulary("p_type")}, ["p_partkey"]
    )
    return mapped


@query("encode_vocab_long", """
    WITH v AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, o_custkey DESC) - 1 AS i
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
    SELECT o_orderkey, CAST(coalesce(i, -1) AS INTEGER) AS code FROM orders LEFT JOIN v USING (o_custkey)""")
def encode_vocab_long(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    vocabulary = encoding.fit_vocabularies(orders.filter("o_orderstatus <> 'P'"), ["o_custkey"], "frequency")["o_custkey"]
    return encoding.apply_vocabulary(orders, vocabulary, "minus_one", "code").select("o_orderkey", "code")


@query("column_transformer", """
    WITH f AS (SELECT avg(o_totalprice) AS pa, stddev_pop(o_totalprice) AS ps, avg(o_custkey) AS ca, stddev_pop(o_custkey) AS cs FROM orders)
    SELECT o_orderkey, round((o_totalprice - pa) / ps, 6) + 0.0 AS feature_0, round((o_custkey - ca) / cs, 6) + 0.0 AS feature_1,
        CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS DOUBLE) AS feature_2,
        CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS feature_3 FROM orders, f""")
def column_transformer(spark, sf_dir):
    out = encoding.fit_transform(
        table(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"], ["o_orderstatus", "o_orderpriority"], ["o_orderkey"]
    )
    return out.select("o_orderkey", *[rounded(f"feature_{i}").alias(f"feature_{i}") for i in range(4)])


@query("preprocess_fn", """
    WITH f AS (SELECT avg(l_quantity) AS qa, stddev_pop(l_quantity) AS qs, min(l_extendedprice) AS lo,
            max(l_extendedprice) AS hi FROM lineitem),
        v AS (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag DESC) - 1 AS i
            FROM lineitem GROUP BY l_returnflag),
        w AS (SELECT l_suppkey, row_number() OVER (ORDER BY count(*) DESC, l_suppkey DESC) - 1 AS j
            FROM lineitem GROUP BY l_suppkey)
    SELECT l_orderkey, round((l_quantity - qa) / qs, 6) + 0.0 AS quantity, round((l_extendedprice - lo) / (hi - lo), 6) + 0.0 AS price,
        CAST(i AS INTEGER) AS flag, CAST(j AS INTEGER) AS supplier
    FROM lineitem JOIN v USING (l_returnflag) JOIN w USING (l_suppkey), f""")
def preprocess_fn(spark, sf_dir):
    def function(analyzer: encoding.Analyzer):
        return {
            "quantity": analyzer.z_score("l_quantity"), "price": analyzer.min_max("l_extendedprice"),
            "flag": analyzer.vocabulary("l_returnflag"), "supplier": analyzer.vocabulary("l_suppkey"),
        }

    mapped, _ = encoding.run_preprocessing(table(spark, sf_dir, "lineitem"), function, ["l_orderkey"])
    return mapped.select("l_orderkey", rounded("quantity").alias("quantity"), rounded("price").alias("price"), "flag", "supplier")


def _fitted_sql(refit: bool) -> str:
    by = "split" if refit else "'all'"
    source = "" if refit else " WHERE split = 'train'"
    return f"""
    WITH {THREE_WAY},
        src AS (SELECT *, {by} AS fit FROM parts),
        fitted AS (SELECT fit, avg(o_totalprice) AS pa, stddev_pop(o_totalprice) AS ps, avg(o_custkey) AS ca,
            stddev_pop(o_custkey) AS cs FROM src{source} GROUP BY fit),
        coded AS (SELECT fit, o_orderpriority AS p, row_number() OVER (PARTITION BY fit ORDER BY o_orderpriority) - 1 AS i
            FROM (SELECT DISTINCT fit, o_orderpriority FROM src{source}))
    SELECT o_orderkey, split, target, round((o_totalprice - pa) / ps, 6) + 0.0 AS feature_0,
        round((o_custkey - ca) / cs, 6) + 0.0 AS feature_1, CAST(coalesce(i, -1) AS DOUBLE) AS feature_2
    FROM src JOIN fitted USING (fit) LEFT JOIN coded ON coded.fit = src.fit AND p = o_orderpriority"""


def processed_orders(spark, sf_dir, per_split: bool = False) -> encounters.Processed:
    """The encounter flow on orders: label, three-way split, fit on train, transform all."""
    orders = labelled_orders(spark, sf_dir).select("o_orderkey", "target", "o_totalprice", "o_custkey", "o_orderpriority")
    split = sampling.three_way_split(orders, "o_orderkey", "target")
    return encounters.process(split, "o_orderkey", ["o_totalprice", "o_custkey"], ["o_orderpriority"], per_split=per_split)


def _show(rows):
    return rows.select("o_orderkey", "split", "target", *[rounded(f"feature_{i}").alias(f"feature_{i}") for i in range(3)])


@query("fit_on_train_apply", _fitted_sql(False))
def fit_on_train_apply(spark, sf_dir):
    return _show(processed_orders(spark, sf_dir).rows)


@query("fit_per_split", _fitted_sql(True))
def fit_per_split(spark, sf_dir):
    return _show(processed_orders(spark, sf_dir, per_split=True).rows)


@query("vocabulary_asset", """
    SELECT p_brand AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand DESC) - 1 AS INTEGER) AS idx
    FROM part GROUP BY p_brand""")
def vocabulary_asset(spark, sf_dir):
    vocabulary = encoding.fit_vocabularies(table(spark, sf_dir, "part"), ["p_brand"], "frequency")["p_brand"]
    path = scratch_path(spark, "vocabulary")
    vocabulary.save(spark, path)
    return spark.read.schema(T.StructType([T.StructField("value", T.StringType()), T.StructField("idx", T.IntegerType())])).parquet(path)

