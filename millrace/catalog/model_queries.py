"""Training, scoring, evaluation, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import ORDER_LABEL, labelled_orders, query, rounded, table
from millrace.operators import encoding, evaluating, registry, sampling, training
from millrace.plans import encounters
from millrace.session import scratch_path
from millrace.sources import tables
from millrace.spec import prediction_schema
from millrace.streaming.scoring import prediction_log

# The label of the model queries follows from one input, so the right prediction is known: the middle priority for
# the models that can bend, the later priorities for the linear ones. A constant model would give other rows.
INPUTS = ["code", "year"]
CODE = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
MIDDLE = f"CASE WHEN {CODE} = 3 THEN 1 ELSE 0 END"
LATE = f"CASE WHEN {CODE} >= 3 THEN 1 ELSE 0 END"


def rule_orders(spark, sf_dir, late: bool = False):
    """Orders with two coded inputs and the 0/1 label of the rule."""
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    rule = code >= 3 if late else code == 3
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", code.alias("code"), F.year("o_orderdate").alias("year"), rule.cast("double").alias(training.LABEL))


def scaled_orders(spark, sf_dir, late: bool = False):
    rows = rule_orders(spark, sf_dir, late)
    return encoding.scale(rows, encoding.fit_numeric(rows, INPUTS), encoding.standard)


def _quality(model, df):
    """Class counts of the predictions against the label."""
    scored = training.score(model, df)
    return scored.groupBy(F.col(training.LABEL).cast("int").alias("label"), "predicted").agg(F.count(F.lit(1)).alias("n"))


def _quality_sql(label: str, source: str = "orders") -> str:
    return f"SELECT {label} AS label, {label} AS predicted, count(*) AS n FROM {source} GROUP BY 1, 2"


@query("train_logreg", _quality_sql("CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END", "lineitem"))
def train_logreg(spark, sf_dir):
    names = ["l_quantity", "l_tax", "is_a", "is_n"]
    rows = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_tax", (F.col("l_returnflag") == "A").cast("double").alias("is_a"),
        (F.col("l_returnflag") == "N").cast("double").alias("is_n"), "l_returnflag")
    coded, _ = encoding.encode_labels(rows, ["l_returnflag"])
    scaled = encoding.scale(coded, encoding.fit_numeric(coded, names), encoding.minmax)
    labelled = scaled.withColumn(training.LABEL, F.col("l_returnflag").cast("double"))
    return _quality(training.train_logistic(labelled, names), labelled)


@query("train_rbf_svm", _quality_sql(MIDDLE))
def train_rbf_svm(spark, sf_dir):
    rows = scaled_orders(spark, sf_dir)
    return _quality(training.train_rbf_svm(rows, INPUTS), rows)


def _probabilities(scored):
    """The prediction, and whether the probability is one and agrees with it."""
    p = F.col("probability")
    return scored.select(
        "o_orderkey", "predicted", p.between(0.0, 1.0).alias("in_range"), ((p >= 0.5).cast("int") == F.col("predicted")).alias("agrees"))


def _probabilities_sql(label: str) -> str:
    return f"SELECT o_orderkey, {label} AS predicted, true AS in_range, true AS agrees FROM orders"


@query("rbf_svm_proba", _probabilities_sql(MIDDLE))
def rbf_svm_proba(spark, sf_dir):
    rows = scaled_orders(spark, sf_dir)
    return _probabilities(training.score_probability(training.train_rbf_svm(rows, INPUTS), rows))


@query("train_linear_svm", _probabilities_sql(LATE))
def train_linear_svm(spark, sf_dir):
    rows = scaled_orders(spark, sf_dir, late=True)
    return _probabilities(training.score_probability(training.train_linear_svm(rows, INPUTS), rows))


@query("train_rf", _quality_sql(MIDDLE))
def train_rf(spark, sf_dir):
    rows = rule_orders(spark, sf_dir)
    return _quality(training.train_forest(rows, INPUTS), rows)


@query("grid_search", """
    SELECT CAST(range AS INTEGER) AS candidate, (SELECT count(*) FROM orders) > 0 AS learnt FROM range(4)""")
def grid_search(spark, sf_dir):
    """Four candidates, five folds; a constant model is right for four orders in five."""
    rows = scaled_orders(spark, sf_dir)
    found = training.grid_search_rbf(rows, INPUTS, "o_orderkey")
    cells = [(i, float(v) >= 0.95) for i, v in enumerate(found.avgMetrics)]
    return spark.createDataFrame(cells, "candidate int, learnt boolean")


@query("grid_search_choice", """
    SELECT 1.0::DOUBLE AS cost, 'scale' AS gamma, 4::BIGINT AS candidates, true AS right_for_all FROM (SELECT count(*) AS n FROM orders) WHERE n > 0""")
def grid_search_choice(spark, sf_dir):
    """A cost near 0 and a kernel without width learn a constant, so one candidate of four is right for every order."""
    rows = scaled_orders(spark, sf_dir)
    found = training.grid_search_rbf(rows, INPUTS, "o_orderkey", costs=(1e-12, 1.0), gammas=(1e-9, "scale"))
    cost, gamma = found.candidates[found.best]
    wrong = training.score(found.bestModel, rows).filter(F.col("predicted") != F.col(training.LABEL)).count()
    return spark.createDataFrame(
        [(cost, str(gamma), len(found.candidates), wrong == 0)], "cost double, gamma string, candidates long, right_for_all boolean")


@query("train_landmark_svm", _probabilities_sql(MIDDLE))
def train_landmark_svm(spark, sf_dir):
    rows = scaled_orders(spark, sf_dir)
    return _probabilities(training.score_probability(training.train_landmark_svm(rows, INPUTS), rows))


@query("train_evaluate", """
    SELECT 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1_score, 1.0::DOUBLE AS roc_auc
    FROM (SELECT count(*) AS n FROM orders) WHERE n > 0""")
def train_evaluate(spark, sf_dir):
    return training.train_and_evaluate(rule_orders(spark, sf_dir), INPUTS, "o_orderkey")[1]


def _stored_model(spark, rows):
    path = scratch_path(spark, "model")
    training.save_model(training.train_forest(rows, INPUTS), path)
    return training.load_model(path)


NAMED = f"CASE {MIDDLE} WHEN 1 THEN 'YES' ELSE 'NO' END"
CLASSES = {0: "NO", 1: "YES"}


@query("model_inputs", f"""
    WITH first AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1)
    SELECT 0 AS position, 'code' AS name, 'int' AS type, CAST({CODE} AS VARCHAR) AS example FROM first
    UNION ALL SELECT 1, 'year', 'int', CAST(year(o_orderdate) AS VARCHAR) FROM first""")
def model_inputs(spark, sf_dir):
    """What a stored model expects, kept beside it."""
    path = scratch_path(spark, "inputs")
    training.save_inputs(rule_orders(spark, sf_dir), INPUTS, "o_orderkey", path)
    cells = [(i, *cell) for i, cell in enumerate(training.load_inputs(spark, path))]
    return spark.createDataFrame(cells, "position int, name string, type string, example string")


@query("score_batch", f"SELECT o_orderkey, {NAMED} AS predicted FROM orders")
def score_batch(spark, sf_dir):
    rows = rule_orders(spark, sf_dir)
    return training.score(_stored_model(spark, rows), rows, CLASSES).select("o_orderkey", "predicted")


@query("score_proba", _probabilities_sql(MIDDLE))
def score_proba(spark, sf_dir):
    rows = rule_orders(spark, sf_dir)
    return _probabilities(training.score_probability(_stored_model(spark, rows), rows))


@query("score_log", f"""
    SELECT o_orderkey AS id, 'forest' AS model_name, {CODE} AS feature_1, CAST(year(o_orderdate) AS INTEGER) AS feature_2,
        o_totalprice AS feature_3, {NAMED} AS label FROM orders""")
def score_log(spark, sf_dir):
    """The log keeps every input in its own type, a price as a double."""
    rows = rule_orders(spark, sf_dir)
    prices = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    scored = training.score(_stored_model(spark, rows), rows.join(prices, "o_orderkey"), CLASSES)
    log = prediction_log(scored, "o_orderkey", "forest", (*INPUTS, "o_totalprice"))
    path = scratch_path(spark, "predictions")
    tables.append_table(log, path)
    return spark.read.schema(prediction_schema(kinds=("int", "int", "double"))).parquet(path)


@query("balanced_svm_quality", """
    SELECT part AS split, true AS accurate, true AS ranks FROM (VALUES ('validation'), ('test')) v(part)
    WHERE (SELECT count(*) FROM orders) > 0""")
def balanced_svm_quality(spark, sf_dir):
    """The whole flow with a balanced sample; the rare class is one priority of five."""
    middle = F.when(F.substring("o_orderpriority", 1, 1) == "3", "YES").otherwise("NO")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", middle.alias("target"), F.year("o_orderdate").alias("year"), "o_orderpriority")
    split = sampling.three_way_split(orders, "o_orderkey", "target")
    processed = encounters.process(split, "o_orderkey", ["year"], ["o_orderpriority"]).store(scratch_path(spark, "processed"))
    model = encounters.train(processed, sample=5000)
    rows = []
    for part in ("validation", "test"):
        found = encounters.measure(model, processed.part(part))
        rows.append((part, found["accuracy"] >= 0.95, found["roc_auc"] >= 0.95))
    return spark.createDataFrame(rows, "split string, accurate boolean, ranks boolean")


@query("registry_flow", """
    SELECT 'priority' AS name, v AS version, CASE v WHEN 1 THEN 'Production' ELSE 'None' END AS stage,
        CASE v WHEN 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS recall, 'code,year' AS columns
    FROM (VALUES (1::BIGINT), (2::BIGINT)) t(v) WHERE (SELECT count(*) FROM orders) > 0""")
def registry_flow(spark, sf_dir):
    """Fit, store, log a run, register a version, promote; then a model of the opposite label, which stays behind."""
    rows = rule_orders(spark, sf_dir)
    runs, versions, models = (scratch_path(spark, f"registry-{p}") for p in ("runs", "versions", "models"))
    opposite = rows.withColumn(training.LABEL, 1.0 - F.col(training.LABEL))
    for number, learnt in enumerate((rows, opposite), 1):
        model = training.train_forest(learnt, INPUTS)
        metrics = training.evaluate(training.score_probability(model, rows), training.LABEL)
        registry.register(spark, runs, versions, models, "priority", model, f"run-{number}", number, {"trees": 100}, metrics, INPUTS)
    stored = registry.promoted(spark, versions, runs)
    columns = spark.read.schema(registry.RUN_SCHEMA).parquet(runs).select("run_id", F.col("tags")["columns"].alias("columns"))
    return stored.join(columns, "run_id").select("name", "version", "stage", rounded("recall").alias("recall"), "columns")


# ------------------------------------------------------------------ evaluation

PREDICTED = "CASE WHEN o_totalprice > 150000 THEN 'YES' ELSE 'NO' END"


def _predicted(spark, sf_dir):
    return labelled_orders(spark, sf_dir).select(
        "target", F.when(F.col("o_totalprice") > 150000, "YES").otherwise("NO").alias("predicted"), "o_totalprice"
    )


@query("binary_metrics", f"""
    WITH s AS (SELECT {ORDER_LABEL} AS t, {PREDICTED} AS p FROM orders),
        c AS (SELECT count(*) AS n, count(CASE WHEN t = p THEN 1 END) AS ok, count(CASE WHEN t = 'YES' AND p = 'YES' THEN 1 END) AS tp,
            count(CASE WHEN p = 'YES' THEN 1 END) AS pp, count(CASE WHEN t = 'YES' THEN 1 END) AS tt FROM s)
    SELECT round(ok / n, 6) AS accuracy, round(tp / pp, 6) AS precision, round(tp / tt, 6) AS recall,
        round(2 * tp / (pp + tt), 6) AS f1_score FROM c""")
def binary_metrics(spark, sf_dir):
    out = evaluating.binary_metrics(_predicted(spark, sf_dir), "target", "predicted")
    return out.select(*[rounded(c).alias(c) for c in out.columns])


def _auc_sql(source: str, score: str, positive: str) -> str:
    return f"""
    WITH s AS (SELECT {score} AS s, {positive} AS p FROM {source}),
        g AS (SELECT s, count(CASE WHEN p THEN 1 END) AS p, count(CASE WHEN NOT p THEN 1 END) AS n FROM s GROUP BY s),
        c AS (SELECT p, n, sum(n) OVER (ORDER BY s) - n AS below FROM g)
    SELECT round(sum(p * (below + n / 2.0)) / (sum(p) * sum(n)), 6) AS roc_auc FROM c"""


@query("roc_auc", _auc_sql("orders", "o_totalprice", f"{ORDER_LABEL} = 'YES'"))
def roc_auc(spark, sf_dir):
    out = evaluating.roc_auc(_predicted(spark, sf_dir), "o_totalprice", F.col("target") == "YES")
    return out.select(rounded("roc_auc").alias("roc_auc"))


@query("roc_auc_ties", _auc_sql("documents JOIN labels USING (doc_id)", "floor(n_chars / 100)", "quality = 1"))
def roc_auc_ties(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("n_chars") / 100).alias("s"))
    scored = documents.join(table(spark, sf_dir, "labels"), "doc_id")
    return evaluating.roc_auc(scored, "s", F.col("quality") == 1).select(rounded("roc_auc").alias("roc_auc"))


FLAGS = "CASE WHEN l_quantity < 15 THEN 'A' WHEN l_quantity < 40 THEN 'N' ELSE 'X' END"


def _flags(spark, sf_dir):
    quantity = F.col("l_quantity")
    guess = F.when(quantity < 15, "A").when(quantity < 40, "N").otherwise("X")
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), guess.alias("guess"))


@query("classification_report", f"""
    WITH s AS (SELECT l_returnflag AS t, {FLAGS} AS p FROM lineitem),
        classes AS (SELECT t AS class FROM s UNION SELECT p FROM s),
        c AS (SELECT class, (SELECT count(*) FROM s WHERE t = class) AS support, (SELECT count(*) FROM s WHERE p = class) AS pp,
            (SELECT count(*) FROM s WHERE t = class AND p = class) AS tp FROM classes),
        m AS (SELECT class, CASE WHEN pp = 0 THEN 0 ELSE tp / pp END AS precision,
            CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
            CASE WHEN pp + support = 0 THEN 0 ELSE 2 * tp / (pp + support) END AS f1_score, support, tp FROM c),
        o AS (SELECT class, precision, recall, f1_score, support FROM m
            UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM m
            UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM m
            UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                sum(f1_score * support) / sum(support), sum(support) FROM m)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
        CAST(support AS BIGINT) AS support FROM o""")
def classification_report(spark, sf_dir):
    out = evaluating.classification_report(_flags(spark, sf_dir), "flag", "guess")
    return out.select("class", *[rounded(c).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@query("confusion_matrix", f"""
    SELECT l_returnflag AS label, count(CASE WHEN {FLAGS} = 'A' THEN 1 END) AS "pred_A", count(CASE WHEN {FLAGS} = 'N' THEN 1 END) AS "pred_N",
        0::BIGINT AS "pred_R", count(CASE WHEN {FLAGS} = 'X' THEN 1 END) AS "pred_X" FROM lineitem GROUP BY l_returnflag""")
def confusion_matrix(spark, sf_dir):
    return evaluating.confusion_matrix(_flags(spark, sf_dir), "flag", "guess")


# -------------------------------------------------------------------- registry


def _runs(spark, sf_dir):
    """Events read as runs: one per event, the event type names the experiment."""
    return table(spark, sf_dir, "events").select(
        "event_type", F.col("event_id").cast("string").alias("run_id"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ts"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        F.create_map(F.lit("recall"), F.col("value")).alias("metrics"),
        F.create_map(F.lit("columns"), F.col("props")).alias("tags"),
    )


@query("run_latest", """
    SELECT event_type, CAST(event_id AS VARCHAR) AS run_id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, CAST(user_id AS VARCHAR) AS user_param,
        value AS recall, props AS columns_tag FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY floor(epoch(ts)) DESC, CAST(event_id AS VARCHAR) DESC) = 1""")
def run_latest(spark, sf_dir):
    path = scratch_path(spark, "runs")
    tables.append_table(_runs(spark, sf_dir), path)
    newest = registry.latest_run(spark.read.parquet(path), "event_type")
    return newest.select(
        "event_type", "run_id", "ts", F.col("params")["user"].alias("user_param"),
        F.col("metrics")["recall"].alias("recall"), F.col("tags")["columns"].alias("columns_tag"),
    )


def _versions(spark, sf_dir):
    """Orders read as model versions: the customer names the model, the order key counts its versions."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("name"), F.col("o_orderkey").alias("version"),
        F.when(F.col("o_orderstatus") == "F", registry.PRODUCTION).otherwise("None").alias("stage"),
        F.col("o_totalprice").alias("recall"),
    )


@query("registry_latest", "SELECT CAST(o_custkey AS VARCHAR) AS name, max(o_orderkey) AS version FROM orders GROUP BY o_custkey")
def registry_latest(spark, sf_dir):
    return registry.latest_versions(_versions(spark, sf_dir))


@query("registry_models", """
    SELECT CAST(o_custkey AS VARCHAR) AS name, o_orderkey AS version,
        CASE o_orderstatus WHEN 'F' THEN 'Production' ELSE 'None' END AS stage FROM orders""")
def registry_models(spark, sf_dir):
    return registry.list_models(_versions(spark, sf_dir))


@query("registry_promote", """
    WITH v AS (SELECT CAST(o_custkey AS VARCHAR) AS name, o_orderkey AS version,
            CASE o_orderstatus WHEN 'F' THEN 'Production' ELSE 'None' END AS stage, o_totalprice AS recall FROM orders),
        latest AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1),
        champion AS (SELECT * FROM v WHERE stage = 'Production' QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1),
        chosen AS (SELECT l.name, l.version FROM latest l LEFT JOIN champion c ON l.name = c.name
            WHERE c.name IS NULL OR l.recall >= c.recall)
    SELECT v.name, v.version, CASE WHEN chosen.name IS NOT NULL THEN 'Production' ELSE v.stage END AS stage, v.recall
    FROM v LEFT JOIN chosen ON v.name = chosen.name AND v.version = chosen.version""")
def registry_promote(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    latest = tables.latest_per_key(versions, ["name"], [F.col("version")])
    production = tables.latest_per_key(versions.filter(F.col("stage") == registry.PRODUCTION), ["name"], [F.col("version")])
    return registry.promote(versions, registry.challengers_to_promote(latest, production))
