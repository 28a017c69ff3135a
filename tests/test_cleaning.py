from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import cleaning, coding
from millrace.spec import ENCOUNTER_SPEC, PENGUIN_SURVEY_SPEC, require_columns

NAN, INF = float("nan"), float("inf")


def test_missing_means_null_or_nan(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, NAN, "b"), (3, None, "c"), (4, 4.0, None)], "k int, x double, s string")
    assert rows(cleaning.drop_missing(df).select("k")) == [(1,)]
    assert rows(cleaning.drop_missing(df, ["x"]).select("k")) == [(1,), (4,)]
    assert rows(cleaning.missing_counts(df)) == [("k", 0, False), ("s", 1, True), ("x", 2, True)]
    assert rows(cleaning.missing_counts(df.limit(0))) == [("k", 0, False), ("s", 0, False), ("x", 0, False)]


def test_sentinel_keeps_null_and_ignores_absent_column(spark):
    df = spark.createDataFrame([(1, "MALE"), (2, "."), (3, None)], "k int, sex string")
    assert rows(cleaning.drop_sentinel(df, "sex", ".").select("k")) == [(1,), (3,)]
    assert cleaning.drop_sentinel(df, "other", ".").count() == 3


def test_tokens_fill_and_numbers(spark):
    df = spark.createDataFrame([("?", "7"), ("a", "V27"), (None, None)], "s string, n string")
    nulled = cleaning.null_tokens(df)
    assert rows(nulled) == [("a", "V27"), (None, "7"), (None, None)]
    numbers = nulled.select("s", cleaning.to_number(F.col("n")).alias("n"))
    filled = cleaning.fill_groups(numbers, [(["s"], "Unknown"), (["n"], 0.0)])
    assert rows(filled) == [("Unknown", 0.0), ("Unknown", 7.0), ("a", 0.0)]


def test_infinities_and_clipping(spark):
    df = spark.createDataFrame([(1, INF, 2e10), (2, -INF, -3e10), (3, NAN, 5.0), (4, None, None), (5, -0.0, 1.0)], "k int, x double, y double")
    assert rows(df.select("k", cleaning.infinite_to_zero(F.col("x")))) == [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0), (5, -0.0)]
    clipped, over = cleaning.clip_large(df, ["y"])
    assert over == {"y": 3e10}
    assert rows(clipped.select("k", "y")) == [(1, 1e10), (2, -1e10), (3, 5.0), (4, None), (5, 1.0)]
    assert cleaning.clip_large(df.filter("k = 5"), ["y"])[1] == {}


def test_labels(spark):
    df = spark.createDataFrame([("<30",), (">30",), ("NO",), (None,)], "r string")
    both = cleaning.binary_label(F.col("r"), ("<30", ">30"))
    strict = cleaning.binary_label(F.col("r"), ("<30",))
    assert [tuple(r) for r in df.select(both, strict).collect()] == [("YES", "YES"), ("YES", "NO"), ("NO", "NO"), ("NO", "NO")]


@pytest.mark.parametrize("code,group", [
    ("389", 0), ("390", 1), ("459", 1), ("459.9", 1), ("460", 2), ("519", 2), ("520", 3), ("579", 3), ("580", 7), ("629", 7),
    ("785", 1), ("786", 2), ("787", 3), ("788", 7), ("250", 4), ("250.83", 4), ("799", 0), ("800", 5), ("999", 5), ("1000", 0),
    ("710", 6), ("739", 6), ("140", 8), ("239", 8), ("240", 0), ("V27", 0), ("?", 0), (None, 0), ("-5", 0),
])
def test_diagnosis_groups(spark, code, group):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(coding.bucket_ranges(F.col("c"))).first()[0] == group


def test_remap_keeps_unmapped(spark):
    df = spark.createDataFrame([(1,), (2,), (7,), (26,), (99,), (None,)], "c int")
    assert [r[0] for r in df.select(coding.remap(F.col("c"), coding.ADMISSION_SOURCE_GROUPS)).collect()] == [1, 1, 7, 4, 99, None]
    assert coding.remap(F.col("c"), {}) is not None


def test_names_with_spaces_and_dashes(spark):
    df = spark.createDataFrame([("A", 1.0, None)], "`Species` string, `Culmen Length (mm)` double, `Delta 15 N (o/oo)` double")
    assert cleaning.drop_missing(df).count() == 0
    assert cleaning.select_present(df, PENGUIN_SURVEY_SPEC.numeric).columns == ["Culmen Length (mm)", "Delta 15 N (o/oo)"]
    renamed = cleaning.rename(spark.createDataFrame([(1, 2)], "`change` int, `glyburide-metformin` int"),
                              {"change": "change_column"}, dash_to_underscore=True)
    assert renamed.columns == ["change_column", "glyburide_metformin"]


def test_present_columns_by_case(spark):
    folded = [c.lower() for c in (*ENCOUNTER_SPEC.features, "readmitted")]
    assert len(ENCOUNTER_SPEC.present_in(folded, case_sensitive=True).features) == 15
    assert len(ENCOUNTER_SPEC.present_in(folded).features) == 17


def test_required_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="b, c"):
        require_columns(df, ["a", "b", "c"])


def test_json_records_write_null_for_nan(spark):
    df = spark.createDataFrame([(1, NAN, "x"), (2, INF, None), (3, 1.5, "y")], "k int, v double, s string")
    got = [json.loads(r[0]) for r in cleaning.json_records(df).collect()]
    assert got == [{"k": 1, "v": None, "s": "x"}, {"k": 2, "v": None, "s": None}, {"k": 3, "v": 1.5, "s": "y"}]
