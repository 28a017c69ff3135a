from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import encoding
from millrace.operators.encoding import ColumnTransformer
from millrace.plans import cover, penguins
from millrace.spec import FeatureSpec


@pytest.fixture(params=["literal", "broadcast", "salted"])
def size(request, monkeypatch):
    """The same encoders with literal, broadcast and large vocabularies."""
    if request.param != "literal":
        monkeypatch.setattr(encoding, "LITERAL_VALUES", 1)
    if request.param == "salted":
        monkeypatch.setattr(encoding, "SMALL_ROWS", 2)
        monkeypatch.setattr(session.SmallTable.of, "__defaults__", ("lookup", 2))
    return request.param


def test_numbers_are_ordered_as_numbers(spark, size):
    df = spark.createDataFrame([(10, "b"), (2, "a"), (33, "c"), (2, None)], "n int, s string")
    v = encoding.fit_vocabularies(df, ["n", "s"])
    out = df
    for c in ("n", "s"):
        out = encoding.apply_vocabulary(out, v[c])
    assert out.columns == ["n", "s"]
    assert rows(out) == [(0, 0), (0, None), (1, 1), (2, 2)]


def test_unseen_values(spark, size):
    v = encoding.fit_vocabularies(spark.createDataFrame([("a",), ("b",), ("c",)], "s string"), ["s"])["s"]
    new = spark.createDataFrame([("b",), ("z",), (None,)], "s string")
    assert rows(encoding.apply_vocabulary(new, v, "minus_one")) == [(-1,), (-1,), (1,)]
    assert rows(encoding.apply_vocabulary(new, v, "null")) == [(1,), (None,), (None,)]
    with pytest.raises(Exception, match="not seen when fitting: z"):
        encoding.apply_vocabulary(new, v, "error").collect()


def test_frequency_order_and_inverse(spark, size):
    # count order, ties to the larger value; one value holds a third of the rows
    data = ["Rawah"] * 50 + ["Commanche"] * 40 + ["Cache"] * 20 + ["Neota"] * 20
    df = spark.createDataFrame([(s,) for s in data], "s string")
    v = encoding.fit_vocabularies(df, ["s"], "frequency")["s"]
    coded = encoding.apply_vocabulary(df, v, "minus_one", "code")
    got = {r["s"]: r["code"] for r in coded.distinct().collect()}
    assert got == {"Rawah": 0, "Commanche": 1, "Neota": 2, "Cache": 3}
    assert (size == "salted") == (v.values is None)
    back = encoding.decode(coded, v, "code", "back")
    assert back.filter("s != back OR back IS NULL").count() == 0 and back.count() == 130


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, s string")
    v = encoding.fit_vocabularies(df, ["s"]).values()
    hot = encoding.one_hot(df, v)
    assert hot.columns == ["k", "s_x", "s_y"] and rows(hot) == [(1, 1, 0), (2, 0, 1), (3, 1, 0)]
    new = spark.createDataFrame([(4, "z")], "k int, s string")
    assert rows(encoding.one_hot(new, v, "ignore")) == [(4, 0, 0)]
    with pytest.raises(Exception, match="not seen"):
        encoding.one_hot(new, v).collect()


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0), (float("nan"), 7.0)], "x double, c double")
    stats = encoding.fit_numeric(df, ["x", "c"])
    assert (stats["x"].low, stats["x"].high, stats["x"].mean, stats["x"].std) == (1.0, 3.0, 2.0, 1.0)
    complete = df.limit(2)
    assert rows(encoding.scale(complete, stats, encoding.minmax)) == [(0.0, 0.0), (1.0, 0.0)]
    assert rows(encoding.scale(complete, stats, encoding.standard)) == [(-1.0, 0.0), (1.0, 0.0)]
    none = encoding.fit_numeric(df.limit(0), ["x"])
    assert encoding.scale(complete, none, encoding.minmax).first()["x"] is None


def test_row_length(spark):
    df = spark.createDataFrame([(3.0, 4.0, 1), (0.0, 0.0, 2)], "a double, b double, k int")
    assert rows(encoding.normalise_rows(df, ["a", "b"])) == [(0.0, 0.0, 2), (0.6, 0.8, 1)]


def test_transformer_order_and_reuse(spark):
    df = spark.createDataFrame([(1, "b", 0.0), (2, "a", 2.0), (3, "b", 4.0)], "k int, s string, x double")
    fitted = ColumnTransformer.fit(df, ["x"], ["s"])
    out = fitted.transform(df, ["k"])
    assert out.columns == ["k", "feature_0", "feature_1"]
    assert rows(out) == rows(encoding.fit_transform(df, ["x"], ["s"], ["k"]))
    assert rows(ColumnTransformer.from_json(fitted.to_json()).transform(df, ["k"])) == rows(out)
    new = spark.createDataFrame([(9, "z", 2.0)], "k int, s string, x double")
    assert rows(fitted.transform(new, ["k"])) == [(9, 0.0, -1.0)]
    hot = ColumnTransformer.fit(df, ["x"], ["s"], encoder="onehot")
    assert hot.feature_names() == ["x", "s_a", "s_b"]
    assert hot.transform(df, ["k"], prefix=None).columns == ["k", "x", "s_a", "s_b"]


def test_two_phase_function(spark, size):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("b", 5.0, 5.0), ("c", 3.0, 5.0)], "s string, x double, c double")
    spec = FeatureSpec(("x", "c"), ("s",))
    out, analyzer = cover.transform(df, spec)
    assert out.columns == ["x", "c", "s"]
    scale = math.sqrt(2.0)
    got = sorted((round(r["x"], 6), r["c"], r["s"]) for r in out.collect())
    assert got == sorted([(round(-2 / scale, 6), 0.0, 2), (0.0, 0.0, 0), (round(2 / scale, 6), 0.0, 0), (0.0, 0.0, 1)])
    serving = spark.createDataFrame([("new", 3.0, 9.0)], "s string, x double, c double")
    again = encoding.apply_preprocessing(serving, cover.preprocessing(spec), analyzer)
    assert rows(again) == [(0.0, 4.0, -1)]


def test_penguin_table(spark):
    data = [
        ("Adelie", "Torgersen", 39.0, 18.0, 180.0, 3700.0, "MALE"), ("Gentoo", "Biscoe", 49.0, 14.0, 220.0, 5700.0, "FEMALE"),
        ("Adelie", "Torgersen", None, None, None, None, None), ("Adelie", "Dream", 34.0, 18.5, 190.0, 3500.0, None),
        ("Gentoo", "Biscoe", 44.5, 15.7, 217.0, 4875.0, "."), ("Chinstrap", "Dream", 44.0, 16.0, 200.0, 4700.0, "MALE"),
    ]
    names = "species string, island string, culmen_length_mm double, culmen_depth_mm double, flipper_length_mm double, body_mass_g double, sex string"
    table, vocabularies = penguins.training_table(spark.createDataFrame(data, names))
    assert vocabularies["species"].values == ("Adelie", "Chinstrap", "Gentoo")
    assert vocabularies["sex"].values == ("FEMALE", "MALE")
    got = {r["species"]: (r["island"], r["sex"], r["culmen_length_mm"], r["body_mass_g"]) for r in table.collect()}
    assert got == {0: (2, 1, 0.0, 0.0), 1: (1, 1, 0.5, 0.5), 2: (0, 0, 1.0, 1.0)}


def test_soil_table_encodes_before_scaling(spark):
    spec = FeatureSpec(("Elevation",), ("Wilderness_Area", "Soil_Type"), "Cover_Type")
    df = spark.createDataFrame(
        [(1.0, "Rawah", "C1", 1), (3.0, "Cache", "C2", 2), (2.0, "Neota", "C1", 1), (None, "Neota", "C9", 1)],
        "Elevation double, Wilderness_Area string, Soil_Type string, Cover_Type int",
    )
    out = cover.training_table(df, spec, scale=["Elevation", "Wilderness_Area"])
    assert rows(out) == [(0.0, 1.0, 0, 1), (0.5, 0.5, 0, 1), (1.0, 0.0, 1, 2)]


def test_large_lookup_spreads_a_hot_key(spark, monkeypatch):
    big = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    table = session.SmallTable(big.select("v").distinct().withColumn("idx", F.col("v") * 2), None)
    out = session.lookup(big, table, ["v"])
    assert out.count() == 900 and out.filter("idx != v * 2").count() == 0
    keys = big.withColumn("_salt", F.pmod(F.xxhash64("id", "v"), F.lit(session.LOOKUP_SALTS)))
    assert keys.filter("v = 0").select("_salt").distinct().count() == session.LOOKUP_SALTS


def test_large_lookup_stays_off_the_driver(spark, tmp_path):
    # the file is far smaller than its rows, and each row meets every salt
    spark.range(50_000, numPartitions=1).selectExpr("id AS v", "id AS idx").write.parquet(str(tmp_path / "table"))
    table = session.SmallTable(spark.read.parquet(str(tmp_path / "table")), None)
    out = session.lookup(spark.range(100_000).select(F.col("id").alias("v")), table, ["v"])
    assert out.filter("idx = v").count() == 50_000 and out.count() == 100_000
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_fetch_bounded(spark):
    assert len(session.fetch_bounded(spark.range(5), 5)) == 5
    assert session.fetch_bounded(spark.range(6), 5) is None


def test_one_hot_vectors(spark):
    df = spark.createDataFrame(
        [(1, "b", "x"), (2, "a", None), (3, "new", "y"), (4, None, None), (5, "b", "y")], "id int, s string, t string")
    fitted = encoding.fit_vocabularies(df.filter("id <> 3"), ["s", "t"])
    found = {r.id: r.features for r in encoding.one_hot_vector(df, [fitted["s"], fitted["t"]], "ignore").collect()}
    assert {k: v.toArray().tolist() for k, v in found.items()} == {
        1: [0, 1, 1, 0], 2: [1, 0, 0, 0], 3: [0, 0, 0, 1], 4: [0, 0, 0, 0], 5: [0, 1, 0, 1]}
    with pytest.raises(Exception, match="value not seen when fitting: new"):
        encoding.one_hot_vector(df, [fitted["s"]]).collect()
    kept = encoding.one_hot_vector(df.withColumn("features", df.id), [fitted["t"]], drop_source=False)
    assert kept.columns == ["id", "s", "t", "features"] and kept.count() == 5
    none = encoding.fit_vocabularies(df.filter("false"), ["s"])["s"]
    assert encoding.one_hot_vector(df, [none], "ignore").first().features.size == 0


def test_one_hot_vectors_of_a_hundred_thousand_values(spark):
    df = spark.range(100_000).selectExpr("id", "id * 7 % 100003 AS code")
    fitted = encoding.fit_vocabularies(df, ["code"])["code"]
    assert fitted.values is None
    vectors = encoding.one_hot_vector(df, [fitted])
    first = vectors.filter("id = 0").first().features
    assert first.size == 100_000 and first.indices.tolist() == [0] and first.values.tolist() == [1.0]
    largest = df.orderBy(df.code.desc()).first().id
    assert vectors.filter(vectors.id == largest).first().features.indices.tolist() == [99_999]
    # no name for each place in the schema, which the driver holds
    assert vectors.schema["features"].metadata == {"ml_attr": {"num_attrs": 100_000}}


def test_places_of_ones(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, None, None), (3, "a", "y"), (4, "c", "x")], "id int, s string, t string")
    fitted = encoding.fit_vocabularies(df, ["s", "t"])
    for names, wanted in ((["s", "t"], {1: [1, 3], 2: [], 3: [0, 4], 4: [2, 3]}), (["t"], {1: [0], 2: [], 3: [1], 4: [0]})):
        vectors = encoding.one_hot_vector(df, [fitted[n] for n in names])
        assert dict(rows(vectors.select("id", encoding.places_of_ones(F.col("features"))))) == wanted
