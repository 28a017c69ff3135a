from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import ranking


def digest(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.fixture(params=[200_000, 7], ids=["one pass", "refined"])
def sort_rows(request, monkeypatch):
    monkeypatch.setattr(ranking, "SORT_ROWS", request.param)
    monkeypatch.setattr(ranking, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(ranking, "BINS", 16)


def test_cutoffs_choose_exactly_the_first_rows(spark, sort_rows):
    # one group holds most rows
    data = [(i, "hot" if i % 10 else ("cold" if i % 20 else None)) for i in range(1500)]
    df = spark.createDataFrame(data, "k long, g string")
    quotas = {"hot": 400, "cold": 1, None: 1000}
    cut = ranking.hash_cutoffs(df, "k", 5, quotas, "g")
    got = {r["k"] for r in df.filter(ranking.within_cutoff("k", 5, cut, "g")).collect()}
    want = set()
    for g, n in quotas.items():
        members = sorted((k for k, x in data if x == g), key=lambda k: digest(5, k))
        want |= set(members[:n])
    assert got == want


def test_cutoffs_edge_quotas(spark, sort_rows):
    df = spark.range(50).withColumnRenamed("id", "k")
    for n in (0, 1, 49, 50, 80):
        cut = ranking.hash_cutoffs(df, "k", "s", {0: n})
        assert df.filter(ranking.within_cutoff("k", "s", cut)).count() == min(n, 50)
    empty = df.limit(0)
    assert empty.filter(ranking.within_cutoff("k", "s", ranking.hash_cutoffs(empty, "k", "s", {0: 3}))).count() == 0


def test_hash_rank_is_a_permutation_per_group(spark, monkeypatch):
    monkeypatch.setattr(ranking, "prefix_length", lambda n, rows_per_bucket=0: 2)
    df = spark.createDataFrame([(i, "a" if i < 700 else None) for i in range(1000)], "k long, g string")
    got = ranking.hash_rank(df, "k", 1, ["g"]).collect()
    for g in ("a", None):
        members = sorted((r["k"] for r in got if r["g"] == g), key=lambda k: digest(1, k))
        assert {r["k"]: r["rank"] for r in got if r["g"] == g} == {k: i + 1 for i, k in enumerate(members)}


def test_prefix_length_grows_with_rows():
    assert ranking.prefix_length(0) == ranking.prefix_length(10) == 1
    assert 16 ** ranking.prefix_length(10**12) >= 10**12 / ranking.SORT_ROWS


def test_keys_at_ranks_of_gappy_keys(spark, sort_rows):
    rng = random.Random(3)
    keys = sorted(rng.sample(range(-10**12, 10**12), 900) + list(range(500)))
    keys = sorted(set(keys))
    df = spark.createDataFrame([(k,) for k in rng.sample(keys, len(keys))], "k long")
    ranks = [1, 2, 17, 450, len(keys) - 1, len(keys)]
    assert ranking.key_at_ranks(df, "k", [0, *ranks, len(keys) + 1]) == {r: keys[r - 1] for r in ranks}
    assert ranking.key_at_ranks(df.limit(0), "k", [1]) == {}


def test_global_positions_follow_the_order(spark):
    data = [(i, i % 3) for i in range(500)]
    df = spark.createDataFrame(data, "k long, g int").repartition(7)
    got = {r["k"]: r["position"] for r in ranking.global_positions(df, [F.desc("g"), F.asc("k")]).collect()}
    want = {k: i for i, (k, _) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])))}
    assert got == want


@pytest.mark.parametrize("shape", ["uniform", "hot value", "wide range", "constant"])
def test_exact_quantiles_without_the_built_in(spark, monkeypatch, shape):
    monkeypatch.setattr(ranking, "SORT_ROWS", 20)
    rng = random.Random(1)
    values = {
        "uniform": [rng.random() for _ in range(3000)],
        "hot value": [5.0] * 2000 + [rng.gauss(5, 1) for _ in range(1000)],
        "wide range": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-200, 200) for _ in range(3000)],
        "constant": [2.5] * 3000,
    }[shape]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(5)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = ranking.exact_quantiles(df, ["x"], probs, small=10, accuracy=50)["x"]
    assert np.allclose(got, np.quantile(values, probs), rtol=1e-12)
    assert np.allclose(ranking.exact_quantiles(df, ["x"], probs)["x"], np.quantile(values, probs), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert ranking.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert ranking.exact_quantiles(df, ["x"], [0.5], small=-1) == {"x": [None]}


def test_ranks_take_one_full_shuffle(spark):
    rows = [(i, None if i % 7 == 0 else f"g{i % 3}", f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k long, g string, payload string").repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = ranking.hash_rank(df, "k", 1, ["g"], "rank", 500)
        plan = ranked._jdf.queryExecution().explainString(ranked.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        nodes = [n for n in plan.split("\n\n") if ") Exchange" in n and "payload" in n and "RoundRobin" not in n]
        assert len(nodes) == 1 and "_key" in nodes[0]
        got = ranked.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert ranked.columns == ["k", "g", "payload", "rank"]
    for group in {r.g for r in got}:
        mine = [r.rank for r in got if r.g == group]
        assert sorted(mine) == list(range(1, len(mine) + 1))


def test_quantiles_of_infinite_and_equal_values(spark):
    import math

    values = [-math.inf] * 40 + [0.0] * 300 + [float(i) for i in range(50)] + [math.inf] * 30 + [math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    ranks = (0, 20, 41, 200, 350, 380, 395, 419)
    probs = [k / (len(kept) - 1) for k in ranks]
    quantiles, row = ranking.quantiles_beside(df, ["x"], probs, [F.count("x").alias("n")], small=-1, accuracy=20)
    assert quantiles["x"] == pytest.approx([kept[k] for k in ranks]) and row["n"] == 421
