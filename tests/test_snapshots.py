from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import sampling
from millrace.sources import batches, snapshots, tables

SCHEMA = "k int, v string, batch_number int, p string"
START = [(1, "old", 0, "a"), (2, "old", 5, "a"), (3, "old", 1, "b/*[x]"), (4, "old", 1, None), (5, "old", 1, "01")]


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_an_update_reads_and_writes_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.newest_version(spark, path) == 0
    assert snapshots.write_table(spark.createDataFrame(START, SCHEMA), path, "p") == 1
    assert rows(snapshots.read_table(spark, path)) == rows(spark.createDataFrame(START, SCHEMA))
    changes = spark.createDataFrame([(1, "b1", 1, "a"), (1, "b2", 2, "a"), (2, "late", 4, "a"), (6, "new", 1, None), (7, "new", 1, "c c")], SCHEMA)
    table = snapshots.read_table(spark, path)
    touched = snapshots.touched_rows(table, changes, "p")
    assert {r.p for r in touched.collect()} == {"a", None}
    assert "PartitionFilters: [(p" in plan(touched) and len({r.f for r in touched.select(F.col("_metadata.file_path").alias("f")).collect()}) == 2
    assert snapshots.upsert_table(spark, path, changes, ["k"]) == 2
    want = [(1, "b2", 2, "a"), (2, "old", 5, "a"), (3, "old", 1, "b/*[x]"), (4, "old", 1, None), (5, "old", 1, "01"), (6, "new", 1, None), (7, "new", 1, "c c")]
    assert rows(snapshots.read_table(spark, path)) == rows(spark.createDataFrame(want, SCHEMA))
    assert rows(snapshots.read_table(spark, path, 1)) == rows(spark.createDataFrame(START, SCHEMA))
    written = {f.name for f in (tmp_path / "t" / "data" / "snapshot_version=2").iterdir() if f.is_dir()}
    assert written == {"p=a", "p=__HIVE_DEFAULT_PARTITION__", "p=c c"}


def test_many_touched_partitions_are_joined(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.write_table(spark.createDataFrame(START, SCHEMA), path, "p")
    monkeypatch.setattr(snapshots, "fetch_bounded", lambda df: None)
    changes = spark.createDataFrame([(4, "new", 2, None), (1, "new", 2, "a")], SCHEMA)
    touched = snapshots.touched_rows(snapshots.read_table(spark, path), changes, "p")
    assert sorted(r.k for r in touched.collect()) == [1, 2, 4]
    snapshots.upsert_table(spark, path, changes, ["k"])
    assert {r.k: r.v for r in snapshots.read_table(spark, path).collect()} == {1: "new", 2: "old", 3: "old", 4: "new", 5: "old"}


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_table(spark.createDataFrame(START, SCHEMA), path, "p")
    changes = spark.createDataFrame([(1, "new", 9, "a"), (3, "new", 9, "b/*[x]")], SCHEMA)
    broken = changes.withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        snapshots.upsert_table(spark, path, broken, ["k"])
    assert rows(snapshots.read_table(spark, path)) == rows(spark.createDataFrame(START, SCHEMA))
    assert snapshots.upsert_table(spark, path, changes, ["k"]) == 2
    assert {r.k for r in snapshots.read_table(spark, path).filter("v = 'new'").collect()} == {1, 3}


def test_two_writers_and_empty_tables(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with pytest.raises(LookupError):
        snapshots.read_table(spark, path)
    empty = spark.createDataFrame([], SCHEMA)
    assert snapshots.write_table(empty, path, "p") == 1 and snapshots.read_table(spark, path).count() == 0
    assert snapshots.upsert_table(spark, path, empty, ["k"]) == 1
    assert snapshots.upsert_table(spark, path, spark.createDataFrame(START, SCHEMA), ["k"]) == 2
    assert snapshots.read_table(spark, path).count() == 5
    with pytest.raises(snapshots.ChangedMeanwhile):
        snapshots._publish(spark.createDataFrame(START[:1], SCHEMA), path, "p", 1, ())
    with pytest.raises(ValueError):
        snapshots.write_table(empty.withColumn("snapshot_version", F.lit(1)), path, "p")


def test_equal_numbers_are_ruled(spark):
    versions = [(1, "b", 3, [1]), (1, "c", 3, [0]), (1, "c", 3, [2]), (1, None, 3, [9]), (2, None, None, None)]
    schema = "k int, v string, batch_number int, more array<int>"
    for order in (versions, versions[::-1]):
        found = tables.latest_per_key(spark.createDataFrame(order, schema).repartition(3), ["k"], [F.col("batch_number")])
        assert sorted(tuple(r) for r in found.collect()) == [(1, "c", 3, [2]), (2, None, None, None)]
    with_map = spark.createDataFrame([(1, {"a": 1}, 0), (1, {"a": 2}, 1)], "k int, m map<string,int>, batch_number int")
    assert tables.latest_per_key(with_map, ["k"], [F.col("batch_number")]).first().m == {"a": 2}


def test_pages_by_index(spark):
    df = spark.createDataFrame([(i * 7 % 101 + (i > 50) * 1000, str(i)) for i in range(101)] + [(None, "x")], "k long, v string")
    index = sampling.page_index(df, "k", 25)
    assert sorted((r.batch_number, r.n_rows) for r in index.collect()) == [(0, 25), (1, 25), (2, 25), (3, 25), (4, 1)]
    keys = sorted(r.k for r in df.collect() if r.k is not None)
    for number in range(5):
        assert sorted(r.k for r in sampling.indexed_page(df, "k", index, number).collect()) == keys[number * 25:number * 25 + 25]
    with pytest.raises(sampling.PageNotFound, match="last page is 4"):
        sampling.indexed_page(df, "k", index, 5)
    assert sampling.page_index(df.filter("false"), "k").count() == 0


def test_files_of_a_landed_group_follow_its_bytes(spark, tmp_path):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', 'g' || id % 50) as g", "array_join(transform(sequence(1, 20), x -> md5(concat(id, ':', x))), '') as t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "64")
    try:
        batches.land_groups(df.repartition(16), "g", str(tmp_path / "l"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    files = lambda g: len(list((tmp_path / "l" / f"g={g}").glob("*.json")))
    small = sorted(files(f"g{i}") for i in range(50))
    # small groups dealt to the task of the hot one are cut with it
    assert files("hot") > 3 and small[0] == small[len(small) // 2] == 1
    assert spark.read.json(str(tmp_path / "l")).count() == 3000
