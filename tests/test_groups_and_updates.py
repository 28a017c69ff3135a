from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import profiling, validating
from millrace.operators.ranking import grouped_quantile
from millrace.streaming import merge, traffic


def test_quantiles_of_many_groups_and_of_a_large_one(spark):
    draw = np.random.default_rng(3)
    small = [(f"g{i % 900}", float(draw.choice([draw.normal(), 7.0]))) for i in range(4000)] + [("one", 2.0), ("none", None), (None, 5.0), (None, 6.0), ("nan", float("nan"))]
    large = [("big", float(v)) for v in np.concatenate([draw.lognormal(0, 3, 60_000), np.full(9000, 1.5)])]
    df = spark.createDataFrame(small + large, "g string, v double").repartition(7)
    for share in (0.95, 0.5, 0.0, 1.0):
        got = {r.group: r.quantile for r in grouped_quantile(df, "g", "v", share).collect()}
        want = {}
        for g, v in small + large:
            if v is not None and v == v:
                want.setdefault(g, []).append(v)
        assert got == {g: pytest.approx(float(np.quantile(v, share))) for g, v in want.items()}
    assert grouped_quantile(df.limit(0), "g", "v", 0.5).collect() == []


def test_updates_of_several_batches_equal_the_batch(spark, tmp_path):
    parts = [[1, 5, 12], [3, 25], [8, 14, 14], [4000], [9000, 9001]]
    for i, seconds in enumerate(parts):
        spark.createDataFrame([(s,) for s in seconds], "s long").select(F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(
            str(tmp_path / "in" / f"{i}"))
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    target = str(tmp_path / "out")
    rates = traffic.request_rate(stream, "ts")
    running = merge.write_updates(rates, target, str(tmp_path / "p"))
    running.awaitTermination()
    states = [s["numRowsTotal"] for progress in running.recentProgress for s in progress["stateOperators"]]
    assert states[-1] < max(states)  # windows behind the watermark have left
    want = rows(traffic.request_rate(spark.read.parquet(str(tmp_path / "in" / "*")), "ts"))
    merged = merge.read_merged(spark, rates, ["window_start"], target)
    assert rows(merged) == want and len(want) == 5
    # a batch that is written again changes nothing; nor does folding all batches into one
    kept = spark.createDataFrame(spark.read.schema(rates.schema).parquet(f"{target}/{merge.BATCH}=2").collect(), rates.schema)
    merge.write_batch(kept, 2, target)
    assert rows(merge.read_merged(spark, rates, ["window_start"], target)) == want
    merge.compact(spark, rates, ["window_start"], target, str(tmp_path / "small"))
    assert rows(merge.read_merged(spark, rates, ["window_start"], str(tmp_path / "small"))) == want


def test_domains_of_any_size_are_checked(spark, tmp_path):
    seen = spark.createDataFrame([(f"v{i}", "x") for i in range(401)] + [(None, "y")], "long string, short string")
    constraints = validating.infer_constraints(seen)
    assert [c.enum for c in constraints] == [None, ("x", "y")] and constraints[0].values_path
    new = spark.createDataFrame([("zzz", "x"), ("v7", "x"), ("zzz", "z")], "long string, short string")
    want = [("long", "unexpected_value", 2), ("short", "unexpected_value", 1)]
    assert rows(validating.anomalies(new, constraints)) == want
    path = str(tmp_path / "c")
    validating.save_constraints(spark, constraints, path)
    loaded = validating.load_constraints(spark, path)
    assert rows(validating.anomalies(new, loaded)) == want and validating.anomalies(seen, loaded).collect() == []
    assert loaded[0].values_path != constraints[0].values_path  # the values went along
    curated = validating.curate(loaded, {"long": {"enum": ("zzz", "v7")}})
    assert rows(validating.anomalies(new, curated)) == want[1:]


def test_statistics_of_groups_equal_those_of_each(spark):
    data = [(i % 3 if i % 7 else None, float(i * 37 % 11) if i % 5 else None, i, "ab"[i % 2] * (i % 4) or None) for i in range(120)]
    df = spark.createDataFrame(data, "part int, x double, k int, t string")
    got = profiling.feature_stats_by(df, "part")
    assert got.columns == ["part", *profiling.feature_stats(df.drop("part")).columns]
    for part in (0, 1, 2, None):
        same = F.col("part").eqNullSafe(F.lit(part).cast("int"))
        want = profiling.feature_stats(df.filter(same).drop("part")).collect()
        own = {r.feature: r for r in got.filter(same).drop("part").collect()}
        assert len(own) == 3
        for row in want:
            for name, value in row.asDict().items():
                assert own[row.feature][name] == (pytest.approx(value) if isinstance(value, float) else value), (part, row.feature, name)
    assert profiling.feature_stats_by(df.limit(0), "part").collect() == []
