from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import types as T

from millrace import session
from millrace.operators import combining, registry
from millrace.plans import encounters
from millrace.sources import batches, delimited, tables
from millrace.spec import COVER_BATCH_FIELDS, COVER_SPEC, PENGUIN_SCHEMA, TABLES, FeatureSpec, prediction_schema, processed_schema, split_columns


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_tokens_and_types(spark, tmp_path):
    path = write(tmp_path / "p.csv", (
        "species,island,culmen_length_mm,culmen_depth_mm,flipper_length_mm,body_mass_g,sex\n"
        "Adelie,Torgersen,39.1,18.7,181,3750,MALE\nAdelie,Torgersen,NA,NA,NA,NA,NA\nGentoo,Biscoe,nan,,217,4875,.\n"
    ))
    assert rows(delimited.read_csv(spark, path, PENGUIN_SCHEMA)) == [
        ("Adelie", "Torgersen", 39.1, 18.7, 181.0, 3750.0, "MALE"), ("Adelie", "Torgersen", None, None, None, None, None),
        ("Gentoo", "Biscoe", None, None, 217.0, 4875.0, "."),
    ]
    assert delimited.read_csv_raw(spark, path).collect()[1]["culmen_length_mm"] == "NA"
    with pytest.raises(ValueError, match="weight"):
        delimited.read_csv(spark, path, T.StructType([T.StructField("weight", T.DoubleType())]))


def test_malformed_rows_are_set_aside(spark, tmp_path):
    path = write(tmp_path / "m.csv", "a,b\n1,x\ntwo,y\n3,NA\n")
    good, bad = delimited.read_csv_checked(spark, path, T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())]))
    assert rows(good) == [(1, "x"), (3, None)]
    assert rows(bad) == [("two", "y")]
    assert rows(good.select("b")) == [("x",), (None,)]


def test_positional_envelopes(spark, tmp_path):
    row = [str(i) for i in range(10)] + ["Rawah", "C2702", "1"]
    text = "\n".join(json.dumps(d) for d in (
        {"group_number": 1, "batch_number": 3, "data": [row, row[:12]]}, {"group_number": 1, "batch_number": 4, "data": []},
    ))
    df = batches.read_positional(spark, write(tmp_path / "b.json", text), COVER_BATCH_FIELDS, {"Elevation": "double", "Cover_Type": "int"})
    got = df.select("Elevation", "Wilderness_Area", "Cover_Type", "batch_number")
    assert rows(got) == [(0.0, "Rawah", 1, 3), (0.0, "Rawah", None, 3)]


def test_both_record_documents(spark, tmp_path):
    record = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    for i, doc in enumerate([
        {"batch_number": 0, "start_row": 0, "end_row": 1, "batch_size": 1, "data": [{"a": 1, "b": 2.5}]},
        [{"a": 2, "b": None}, {"a": 3}], {"batch_number": 2, "data": []}, [],
    ]):
        write(tmp_path / "r" / f"{i}.json", json.dumps(doc, indent=4))
    assert rows(batches.read_records(spark, str(tmp_path / "r"), record, whole_file=True)) == [(1, 2.5), (2, None), (3, None)]


def test_landing_sets_broken_files_aside_and_lists_failures(spark, tmp_path):
    for g in (1, 2):
        write(tmp_path / "land" / f"group_{g}_data.json", json.dumps({"group_number": g, "batch_number": g}, indent=4))
    write(tmp_path / "land" / "group_3_data.json", "{broken")
    schema = T.StructType([T.StructField("group_number", T.IntegerType()), T.StructField("batch_number", T.IntegerType())])
    good, bad = batches.read_landing(spark, str(tmp_path / "land"), schema, multiline=True)
    assert rows(good.select("group_number")) == [(1,), (2,)]
    assert [r["source_file"].rsplit("/", 1)[1] for r in bad.collect()] == ["group_3_data.json"]
    requested = spark.createDataFrame([(g,) for g in (3, 1, 2, 4)], "group_number int")
    assert rows(combining.failed_groups(requested, good, "group_number")) == [(3,), (4,)]


def test_tables_are_created_once_and_reset(spark, tmp_path):
    where = str(tmp_path / "t")
    tables.create_table(spark, "small", T.StructType([T.StructField("a", T.IntegerType())]), where)
    spark.sql("INSERT INTO small VALUES (1)")
    tables.create_table(spark, "small", T.StructType([T.StructField("a", T.IntegerType())]), where)
    assert tables.read_table(spark, "small").count() == 1
    tables.drop_table(spark, "small")
    assert not spark.catalog.tableExists("small")
    for name in TABLES:
        tables.create_table(spark, name, reset=True)
        assert spark.table(name).schema.names == TABLES[name].names
        tables.drop_table(spark, name)
    assert len(TABLES["encounters_train"]) == 50


def test_replace_append_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.append_table(spark.range(5), path) == 5
    assert tables.append_table(spark.range(3), path, expected=3) == 3
    assert tables.replace_table(spark.range(4), path, expected=4) == 4
    with pytest.raises(RuntimeError, match="expected 9"):
        tables.replace_table(spark.range(4), path, expected=9)


def test_rows_without_any_value_are_skipped(spark):
    df = spark.createDataFrame([("?", None, 1), ("a", None, 1), ("?", 3, 1)], "s string, n int, batch int")
    assert rows(tables.skip_empty_rows(df, ignore=["batch"])) == [("a", None, 1), (None, 3, 1)]


def test_upsert_takes_the_newest(spark, tmp_path):
    current = spark.createDataFrame([(1, "old", 0, 0), (2, "old", 5, 0), (3, "old", 1, 1)], "k int, v string, batch_number int, p int")
    changes = spark.createDataFrame(
        [(1, "b1", 1, 0), (1, "b2", 2, 0), (2, "late", 4, 0), (4, "new", 1, 0)], "k int, v string, batch_number int, p int"
    )
    want = [(1, "b2", 2, 0), (2, "old", 5, 0), (3, "old", 1, 1), (4, "new", 1, 0)]
    assert rows(tables.upsert(current, changes, ["k"])) == want
    path = str(tmp_path / "t")
    current.write.partitionBy("p").parquet(path)
    untouched = sorted(f.name for f in (tmp_path / "t" / "p=1").iterdir())
    tables.upsert_partitions(spark, path, changes, ["k"], "p")
    assert rows(spark.read.parquet(path).select("k", "v", "batch_number", "p")) == want
    assert sorted(f.name for f in (tmp_path / "t" / "p=1").iterdir()) == untouched
    same = spark.createDataFrame([(2, "equal", 5, 0)], "k int, v string, batch_number int, p int")
    assert (2, "equal", 5, 0) in rows(tables.upsert(current, same, ["k"]))


def test_jdbc_options():
    read = tables.jdbc_read_options("jdbc:x", "t", "id", (0, 100), 10)
    assert read["partitionColumn"] == "id" and read["numPartitions"] == "10" and read["upperBound"] == "100"
    assert tables.jdbc_write_options("jdbc:x", "t")["batchsize"] == "15000"
    with pytest.raises(ValueError, match="bound"):
        tables.jdbc_read_options("jdbc:x", "t", "id")


def test_server_info(spark):
    row = tables.server_info(spark).first()
    assert row["database"] == "default" and row["version"].startswith("4.") and row["user"] and row["now"]


def test_schemas():
    assert processed_schema(2).names == ["feature_0", "feature_1", "target"]
    assert len(prediction_schema()) == 18
    assert len(COVER_SPEC.features) == 12


def test_columns_are_parted_as_declared(spark):
    df = spark.createDataFrame([(1, "a", 2)], "x int, s string, code int")
    numeric, categorical = split_columns(df, FeatureSpec(("x",), ("code", "s")))
    assert (numeric.columns, categorical.columns) == (["x"], ["code", "s"])


def test_registry(spark):
    versions = spark.createDataFrame(
        [("svm", 1, "Production", "a"), ("svm", 2, "None", "b"), ("rf", 9, "None", "c"), ("rf", 10, "None", "d")],
        "name string, version int, stage string, source string",
    )
    assert rows(registry.latest_versions(versions)) == [("rf", 10), ("svm", 2)]
    assert registry.list_models(versions).columns == ["name", "version", "stage"]
    champion = spark.createDataFrame([("svm", 0.5), ("x", 0.9)], "name string, recall double")
    latest = spark.createDataFrame([("svm", 2, 0.5), ("rf", 10, 0.1), ("x", 3, 0.89)], "name string, version int, recall double")
    chosen = registry.challengers_to_promote(latest, champion)
    assert rows(chosen) == [("rf", 10), ("svm", 2)]  # equal promotes, no champion promotes, worse does not
    promoted = registry.promote(versions, chosen)
    assert rows(promoted.select("name", "version", "stage")) == [
        ("rf", 10, "Production"), ("rf", 9, "None"), ("svm", 1, "Production"), ("svm", 2, "Production")]
    runs = registry.run_row(spark, "r1", 5, {"C": 1}, {"recall": 0.4}, ["a", "b"]).union(
        registry.run_row(spark, "r2", 9, {"C": 2}, {"recall": 0.6}, ["a", "b"]))
    newest = registry.latest_run(runs).first()
    assert (newest["run_id"], newest["metrics"]["recall"], newest["tags"]["columns"]) == ("r2", 0.6, "a,b")
    assert encounters.should_promote({"recall": 0.5}, None) == "Production"
    assert encounters.should_promote({"recall": 0.5}, {"recall": 0.6}) is None


def test_metrics_side_by_side(spark):
    a = combining.to_long(spark.createDataFrame([(0.5, 0.25)], "accuracy double, recall double"), ["accuracy", "recall"])
    b = combining.to_long(spark.createDataFrame([(0.75, 1.0)], "accuracy double, recall double"), ["accuracy", "recall"])
    assert rows(combining.compare_metrics(a, b)) == [("accuracy", 0.5, 0.75), ("recall", 0.25, 1.0)]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
