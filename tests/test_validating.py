from __future__ import annotations

import json

import pytest
from conftest import rows

from millrace.operators import validating
from millrace.operators.validating import SERVING, TRAINING, Constraint
from millrace.plans import cover


@pytest.fixture()
def good(spark):
    return spark.createDataFrame(
        [(10, 200, "Rawah", "0"), (90, 255, "Cache", "6"), (0, 0, "Rawah", "3")],
        "Slope int, Hillshade_9am int, Wilderness_Area string, Cover_Type string",
    )


@pytest.fixture()
def schema(good):
    return validating.curate(validating.infer_constraints(good), {k: v for k, v in cover.CURATED.items() if k != "Hillshade_Noon"})


def test_inferred_then_curated(good, schema):
    by = {c.feature: c for c in schema}
    assert by["Wilderness_Area"].enum == ("Cache", "Rawah") and by["Wilderness_Area"].type == "BYTES"
    assert (by["Slope"].int_min, by["Slope"].int_max, by["Slope"].min_fraction) == (0, 90, 1.0)
    assert by["Cover_Type"].not_in_env == (SERVING,)
    with pytest.raises(ValueError, match="nothing"):
        validating.curate(schema, {"nothing": {}})


def test_domains_are_listed_only_when_short(spark):
    df = spark.createDataFrame([(str(i), "x") for i in range(4)], "many string, one string")
    assert [c.enum for c in validating.infer_constraints(df, listed_values=3)] == [None, ("x",)]


def test_valid_tables_have_no_anomalies(good, schema):
    assert rows(validating.anomalies(good, schema)) == []
    assert rows(validating.anomalies(good.drop("Cover_Type"), schema, SERVING)) == []


def test_each_violation_is_named(spark, good, schema):
    assert rows(validating.anomalies(good.drop("Cover_Type"), schema, TRAINING)) == [("Cover_Type", "missing_column", 1)]
    bad = spark.createDataFrame(
        [("10", 256, "Mars", "0", 1), ("steep", 200, "Rawah", None, 1), ("91", -1, "Cache", "7", 1)],
        "Slope string, Hillshade_9am int, Wilderness_Area string, Cover_Type string, extra int",
    )
    assert rows(validating.anomalies(bad, schema)) == [
        ("Cover_Type", "low_presence", 1), ("Cover_Type", "unexpected_value", 1), ("Hillshade_9am", "out_of_range", 2),
        ("Slope", "out_of_range", 1), ("Slope", "wrong_type", 1), ("Wilderness_Area", "unexpected_value", 1),
        ("extra", "unexpected_column", 1),
    ]
    empty = rows(validating.anomalies(good.limit(0), schema))
    assert {k for _, k, _ in empty} == {"low_presence"} and len(empty) == 4


def test_fraction_of_presence(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "a int")
    assert rows(validating.anomalies(df, [Constraint("a", "INT", min_fraction=0.75)])) == []
    assert rows(validating.anomalies(df, [Constraint("a", "INT", min_fraction=0.8)])) == [("a", "low_presence", 1)]
    assert rows(validating.anomalies(df, [Constraint("a", "FLOAT", None, 5)])) == [("a", "low_presence", 1)]


def test_saved_schema_is_reloaded(spark, schema, tmp_path):
    validating.save_constraints(spark, schema, str(tmp_path / "schema"))
    assert sorted(validating.load_constraints(spark, str(tmp_path / "schema")), key=lambda c: c.feature) == sorted(schema, key=lambda c: c.feature)


def test_records(spark):
    zeros = {n: 0 for n in validating.COVER_RECORD.names}
    cases = [
        zeros, {k: v for k, v in zeros.items() if k != "Elevation"}, zeros | {"Soil_Type": "x"}, zeros | {"Soil_Type": 1.5},
        zeros | {"Slope": None}, zeros | {"Soil_Type": 3.0, "more": 1},
    ]
    data = [(i, json.dumps(c)) for i, c in enumerate(cases)] + [(6, "not json"), (7, None)]
    parsed = validating.parse_records(spark.createDataFrame(data, "k int, payload string"), validating.COVER_RECORD)
    valid, rejected = validating.split_valid(parsed)
    assert {r["k"] for r in valid.collect()} == {0, 5}
    assert {r["k"]: r["reason"] for r in rejected.collect()} == {
        1: "missing: Elevation", 2: "not a int: Soil_Type", 3: "not a int: Soil_Type", 4: "missing: Slope",
        6: "not an object", 7: "not an object",
    }
    assert len(validating.ENCOUNTER_RECORD.fields) == 17
