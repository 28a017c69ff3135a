from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import ranking, sampling


@pytest.fixture(scope="module")
def encounters(spark):
    """101 766 rows with the class sizes of the published run."""
    label = F.when(F.col("id") < 54_864, "NO").otherwise("YES")
    return spark.range(101_766).select(F.col("id").alias("k"), label.alias("y")).persist()


def counts(df, *by):
    return {tuple(r[: len(by)]) if len(by) > 1 else r[0]: r[-1] for r in df.groupBy(*by).count().collect()}


def test_three_way_split_gives_the_published_sizes(encounters):
    parts = sampling.three_way_split(encounters, "k", "y")
    assert counts(parts, "split", "y") == {
        ("train", "NO"): 32_918, ("train", "YES"): 28_141, ("validation", "NO"): 10_973, ("validation", "YES"): 9_380,
        ("test", "NO"): 10_973, ("test", "YES"): 9_381,
    }
    train = parts.filter("split = 'train'").drop("split")
    assert counts(sampling.undersample(train, "k", "y", "auto"), "y") == {"NO": 28_141, "YES": 28_141}
    assert sampling.page_count(train.count()) == 5


def test_many_classes_use_the_table_path_with_equal_result(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("k"), F.nullif(F.col("id") % 37, F.lit(5)).alias("y"))
    literal = rows(sampling.three_way_split(df, "k", "y"))
    flagged = rows(sampling.stratified_split(df, "k", "y", 0.3))
    monkeypatch.setattr(ranking, "MAX_GROUPS", 5)
    assert rows(sampling.stratified_split(df, "k", "y", 0.3)) == flagged
    assert rows(sampling.three_way_split(df, "k", "y").select("k", "y", "split")) == literal


def test_split_is_disjoint_covering_and_exact(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    flagged = sampling.random_split(df, "k", 0.3)
    assert flagged.count() == 101
    assert flagged.filter("is_test").count() == 31
    assert rows(flagged) == rows(sampling.random_split(df.repartition(7), "k", 0.3))
    assert rows(flagged) != rows(sampling.random_split(df, "k", 0.3, seed=1))


def test_largest_remainder():
    assert sampling.largest_remainder({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}
    assert sampling.largest_remainder({"a": 5, "b": 3}, 3) == {"a": 2, "b": 1}
    assert sampling.largest_remainder({}, 0) == {}
    assert sum(sampling.largest_remainder({None: 3, "x": 4}, 5).values()) == 5


def test_share_uses_the_decimal_fraction():
    assert sampling.share(10, 0.3) == 3
    assert sampling.share(100, 0.07) == 7
    assert sampling.share(5, 0.5, "round") == 2


@pytest.mark.parametrize("strategy,kept", [("auto", 30), ("majority", 30), (1.0, 30), (0.5, 60), (0.4, 70), (2, 15)])
def test_undersample_keeps_the_minority(spark, strategy, kept):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") < 30, "YES").otherwise("NO").alias("y"))
    assert counts(sampling.undersample(df, "k", "y", strategy), "y") == {"YES": 30, "NO": kept}


def test_undersample_rejects_other_than_two_classes(spark):
    for n in (1, 3):
        df = spark.range(9).select(F.col("id").alias("k"), (F.col("id") % n).alias("y"))
        with pytest.raises(ValueError, match="two classes"):
            sampling.undersample(df, "k", "y")
    with pytest.raises(ValueError, match="strategy"):
        sampling.undersample_quota({"a": 1, "b": 2}, "other")
    assert sampling.undersample_quota({"b": 2, "a": 2})[0] == "a"


def test_pages(spark):
    df = spark.range(0, 95, 3).withColumnRenamed("id", "k")  # 32 rows
    seen = []
    for number in range(4):
        page, info = sampling.page(df, "k", number, 10)
        seen += [r["k"] for r in page.orderBy("k").collect()]
        assert info == {"batch_number": number, "start_row": number * 10, "end_row": min(32, number * 10 + 10),
                        "batch_size": 10 if number < 3 else 2}
    assert seen == list(range(0, 95, 3))
    assert sampling.page(df, "k", 1, 10, limit=4)[0].count() == 4
    assert sampling.page(df, "k", 3, 10, limit=4)[0].count() == 2
    assert sampling.page(df, "k", 0, 10, limit=0)[0].count() == 10
    with pytest.raises(ValueError, match="negative"):
        sampling.page(df, "k", -1, 10)
    with pytest.raises(sampling.PageNotFound) as error:
        sampling.page(df, "k", 4, 10)
    assert error.value.last_page == 3


def test_all_pages_at_once_agree_with_single_pages(spark):
    df = spark.range(0, 95, 3).withColumnRenamed("id", "k").repartition(5)
    pages = sampling.assign_pages(df, "k", 10)
    assert rows(pages.filter("batch_number = 2").select("k")) == rows(sampling.page(df, "k", 2, 10)[0])
    assert counts(pages, "batch_number") == {0: 10, 1: 10, 2: 10, 3: 2}


def test_a_page_is_a_pushed_down_key_range(spark, tmp_path):
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    page, _ = sampling.page(spark.read.parquet(str(tmp_path / "t")), "k", 2, 100)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,200)" in plan and "Exchange" not in plan


def test_a_split_of_a_table_shuffles_nothing(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert "Exchange" not in sampling.random_split(df, "k", 0.3)._jdf.queryExecution().executedPlan().toString()


def test_slices_take_a_tenth_of_each(spark):
    df = spark.range(1007).withColumnRenamed("id", "k")
    drawn = sampling.slice_sample(df, "k")
    assert counts(drawn, "slice") == {i: 10 for i in range(10)}
    assert drawn.filter("k div 100 != slice").count() == 0
    assert sampling.slice_sample(df.limit(5), "k").count() == 0


def test_folds_are_balanced_inside_classes(spark):
    df = spark.range(103).select(F.col("id").alias("k"), (F.col("id") < 23).alias("y"))
    per = counts(sampling.kfold(df, "k", "y", 5), "y", "fold")
    assert sorted(per[(True, i)] for i in range(5)) == [4, 4, 5, 5, 5]
    assert sorted(per[(False, i)] for i in range(5)) == [16] * 5


def test_hash_split_is_two_to_one_and_row_local(spark):
    df = spark.range(9000).withColumnRenamed("id", "k")
    parts = counts(df.withColumn("s", sampling.hash_split("k")), "s")
    assert abs(parts["train"] - 6000) < 200
    assert ranking.order_hash(1, "k") is not None


def test_samples(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    assert sampling.sample_rows(df, "k", 7).count() == 7
    assert sampling.sample_rows(df, "k", 99).count() == 50
    assert sampling.sample_fraction(df, "k", 0.25).count() == 12
