"""Encoders and scalers as fit / transform pairs.

`fit` reads the data with one aggregate for all numeric columns and one grouped count
for all categorical columns. `transform` is a projection with fitted values as literals,
or a lookup join when a vocabulary is long.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from decimal import Decimal

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import drop_missing, q
from millrace.operators.ranking import global_positions
from millrace.session import SMALL_ROWS, SmallTable, fetch_bounded, lookup, materialise

UNKNOWN = -1
LITERAL_VALUES = 64  # vocabularies up to this size become a literal expression


# ---------------------------------------------------------------- vocabularies


@dataclass(frozen=True)
class Vocabulary:
    """Ordered distinct values of one column: value -> position."""

    column: str
    values: tuple | None            # when short enough to hold on the driver; numbers, else the text of the value
    table: SmallTable | None = None  # (value, idx) otherwise
    dtype: T.DataType | None = None

    def index_table(self, spark: SparkSession, dtype: T.DataType) -> SmallTable:
        if self.table is not None:
            return self.table
        rows = tuple(Row(value=v, idx=i) for i, v in enumerate(self.values))
        held = dtype if _is_plain(dtype) else T.StringType()
        schema = T.StructType([T.StructField("value", held), T.StructField("idx", T.IntegerType())])
        df = spark.createDataFrame([tuple(r) for r in rows], schema)
        return SmallTable(df.withColumn("value", F.col("value").cast(dtype)), rows)

    def size(self) -> int:
        return len(self.values) if self.values is not None else self.table.df.count()

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the vocabulary as an asset: (value, idx) in parquet."""
        dtype = T.StringType()
        if self.values and isinstance(self.values[0], int):
            dtype = T.LongType()
        self.index_table(spark, dtype).df.write.mode("overwrite").parquet(path)


def fit_vocabularies(df: DataFrame, names: Sequence[str], order: str = "value") -> dict[str, Vocabulary]:
    """Vocabularies of several columns from one grouped count.

    `order`: 'value' sorts natively ascending (numbers as numbers), 'frequency' by
    falling count and, for ties, falling value. Missing values have no entry.
    """
    types = {c: df.schema[c].dataType for c in names}
    counts = value_counts_long(df, names)
    rows = fetch_bounded(counts, SMALL_ROWS)
    if rows is not None:
        return {c: _short_vocabulary([r for r in rows if r["column"] == c], c, types[c], order) for c in names}
    # some column is long; each column is held or kept as a table by its own number of values
    counts = materialise(counts, "value-counts")
    sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}  # a row for each named column
    return {
        c: _long_vocabulary(counts, c, types[c], order) if sizes.get(c, 0) > SMALL_ROWS
        else _short_vocabulary(counts.filter(F.col("column") == c).collect(), c, types[c], order)
        for c in names
    }


def _short_vocabulary(rows: Sequence[Row], name: str, dtype: T.DataType, order: str) -> Vocabulary:
    mine = [(_native(r["value"], dtype), r["n"]) for r in rows]
    value = (lambda vn: Decimal(vn[0])) if isinstance(dtype, T.DecimalType) else lambda vn: vn[0]
    if order == "frequency":
        mine.sort(key=value, reverse=True)
        mine.sort(key=lambda vn: -vn[1])
    else:
        mine.sort(key=value)
    return Vocabulary(name, tuple(v for v, _ in mine), dtype=dtype)


def _is_plain(dtype: T.DataType) -> bool:
    """Types whose values are held as they are; others (dates, decimals ...) are held as text and cast by Spark."""
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType))


def _native(text: str, dtype: T.DataType):
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(text)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(text)
    return text


def _long_vocabulary(counts: DataFrame, name: str, dtype: T.DataType, order: str) -> Vocabulary:
    """The vocabulary of one column from the written (column, value, n) table, ranked without a single-task sort."""
    mine = counts.filter(F.col("column") == name).select(F.col("value").cast(dtype).alias("value"), "n")
    by = [F.desc("n"), F.desc("value")] if order == "frequency" else [F.asc("value")]
    placed = global_positions(mine, by, "idx", "vocabulary")
    return Vocabulary(name, None, SmallTable.of(placed.select("value", F.col("idx").cast("int").alias("idx"))))


def value_counts_long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value as text, n) for all columns in one grouped count; NULLs left out."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in names
    ]))
    return (
        df.select(pairs.alias("p"))
        .select("p.column", "p.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _literal_index(col: Column, values: Sequence, dtype: T.DataType | None) -> Column:
    if dtype is not None and not _is_plain(dtype):
        values = [F.lit(v).cast(dtype) for v in values]
    out = F.when(col == F.lit(values[0]), F.lit(0)) if values else F.lit(None).cast("int")
    for i, v in enumerate(values[1:], 1):
        out = out.when(col == F.lit(v), F.lit(i))
    return out


def apply_vocabulary(
    df: DataFrame, vocabulary: Vocabulary, unknown: str = "error", out: str | None = None, source: str | None = None
) -> DataFrame:
    """Replace (or add) a column by the position of its value.

    `unknown`: 'error' fails on a value outside the vocabulary, 'minus_one' gives -1
    (also for NULL), 'null' gives NULL.
    """
    source = source or vocabulary.column
    out = out or source
    if vocabulary.values is not None and len(vocabulary.values) <= LITERAL_VALUES:
        return df.withColumn(out, _settle(q(source), _literal_index(q(source), vocabulary.values, df.schema[source].dataType), unknown))
    table = vocabulary.index_table(df.sparkSession, df.schema[source].dataType)
    keyed = SmallTable(table.df.select(F.col("value").alias("_v"), F.col("idx").alias("_idx")), table.rows)
    joined = lookup(df.withColumn("_v", q(source)), keyed, ["_v"])
    columns = [*df.columns] if out in df.columns else [*df.columns, out]
    settled = joined.withColumn(out, _settle(F.col("_v"), F.col("_idx"), unknown))
    return settled.select(*[q(c) for c in columns])


def _settle(value: Column, index: Column, unknown: str) -> Column:
    if unknown == "minus_one":
        return F.coalesce(index, F.lit(UNKNOWN))
    if unknown == "null":
        return index
    message = F.concat(F.lit("value not seen when fitting: "), value.cast("string"))
    return F.when(index.isNull() & value.isNotNull(), F.raise_error(message).cast("int")).otherwise(index)


def decode(df: DataFrame, vocabulary: Vocabulary, source: str, out: str, dtype: T.DataType | None = None) -> DataFrame:
    """The value at a position; positions outside the vocabulary give NULL."""
    table = vocabulary.index_table(df.sparkSession, dtype or T.StringType())
    back = table.df.select(F.col("idx").alias("_i"), F.col("value").alias(out))
    return lookup(df.withColumn("_i", q(source)), SmallTable(back, table.rows), ["_i"]).drop("_i")


def one_hot(
    df: DataFrame, vocabularies: Iterable[Vocabulary], unknown: str = "error", drop_source: bool = True
) -> DataFrame:
    """One 0/1 column `<column>_<value>` per known value, no category left out.

    `unknown`: 'error' fails on a new value, 'ignore' gives all zeros. The columns are
    literal expressions, so the vocabulary must be short. Longer ones become one sparse vector
    (`one_hot_vector`), and scores need no columns at all (`selecting.chi2_scores`).
    """
    vocabularies = list(vocabularies)
    sources = {v.column for v in vocabularies}
    columns = [q(c) for c in df.columns if not (drop_source and c in sources)]
    for v in vocabularies:
        if v.values is None:
            raise ValueError(f"{v.column} has too many values for one column each")
        dtype = df.schema[v.column].dataType
        known = q(v.column).isin([F.lit(value).cast(dtype) for value in v.values])
        for value in v.values:
            cell = F.when(q(v.column) == F.lit(value).cast(dtype), F.lit(1)).otherwise(F.lit(0))
            if unknown == "error":
                message = F.concat(F.lit("value not seen when fitting: "), q(v.column).cast("string"))
                cell = F.when(~known, F.raise_error(message).cast("int")).otherwise(cell)
            columns.append(cell.alias(f"{v.column}_{value}"))
    return df.select(*columns)


def one_hot_vector(
    df: DataFrame, vocabularies: Iterable[Vocabulary], unknown: str = "error", out: str = "features", drop_source: bool = True
) -> DataFrame:
    """One vector with a place for every known value of every column, for vocabularies of any length.

    The places follow the vocabularies in turn, no category left out. A row stores one entry per column (the smaller
    of the sparse and the dense form is kept). `unknown`: 'error' fails on a new
    value, 'ignore' leaves its column's places at 0, as a missing value always does.

    The vectors are made row by row, since the stages of Spark ML note a name for every place in the
    schema, which the driver holds. The schema here says how many places there are.
    """
    vocabularies = list(vocabularies)
    sources = {v.column for v in vocabularies}
    columns = [c for c in df.columns if c != out and not (drop_source and c in sources)]
    found, size, indexed = [], 0, df
    for number, v in enumerate(vocabularies):
        index, before, own = f"_index_{number}", size, v.size()
        indexed = apply_vocabulary(indexed, v, "error" if unknown == "error" else "minus_one", index, v.column)
        if own:
            found.append(F.when(q(index) >= 0, q(index) + F.lit(before)))
            size += own
    if not found:
        return indexed.select(*[q(c) for c in columns], array_to_vector(F.array().cast("array<double>")).alias(out))
    placed = indexed.withColumn("_places", F.array_compact(F.array(*found)))
    vector = _sparse_cells(F.col("_places"), size)
    if 1.5 * (len(found) + 1) >= size:
        dense = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains("_places", i).cast("double"))
        vector = F.when(1.5 * (F.size("_places") + 1) < size, vector).otherwise(_cells(F.lit(1), None, None, dense))
    # a struct of the fields of a vector becomes one on its way through text
    schema = T.StructType([T.StructField("vector", VectorUDT())])
    read = F.from_json(F.to_json(F.struct(vector.alias("vector"))), schema)["vector"]
    return placed.select(*[q(c) for c in columns], read.alias(out, metadata={"ml_attr": {"num_attrs": size}}))


def _cells(kind: Column, size: Column | None, indices: Column | None, values: Column) -> Column:
    """The fields of a vector: kind 0 is sparse, 1 dense."""
    return F.struct(
        kind.cast("tinyint").alias("type"), (F.lit(None) if size is None else size).cast("int").alias("size"),
        (F.lit(None) if indices is None else indices).cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))


def _sparse_cells(places: Column, size: int) -> Column:
    return _cells(F.lit(0), F.lit(size), places, F.array_repeat(F.lit(1.0), F.size(places)))


def places_of_ones(vector: Column) -> Column:
    """The places of a one-hot vector's ones, without the zeros between them."""
    cells = F.unwrap_udt(vector)
    dense = F.transform(cells["values"], lambda v, i: F.when(v != 0, i))
    return F.coalesce(cells["indices"], F.array_compact(dense))


# --------------------------------------------------------------------- scalers


@dataclass(frozen=True)
class NumericStats:
    """Fitted moments of one numeric column over its non-missing values."""

    low: float | None
    high: float | None
    mean: float | None
    std: float | None  # population


def fit_numeric(df: DataFrame, names: Sequence[str]) -> dict[str, NumericStats]:
    """Minimum, maximum, mean and population deviation of all columns in one job."""
    if not names:
        return {}
    aggs = []
    for i, c in enumerate(names):
        x = q(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.avg(x).alias(f"c{i}"), F.stddev_pop(x).alias(f"d{i}")]
    row = df.agg(*aggs).first()
    return {c: NumericStats(*(row[f"{k}{i}"] for k in "abcd")) for i, c in enumerate(names)}


def minmax(col: Column, stats: NumericStats) -> Column:
    """(x-min)/(max-min); a constant column becomes 0."""
    if stats.low is None:
        return F.lit(None).cast("double")
    width = stats.high - stats.low
    return (col - F.lit(stats.low)) / F.lit(width if width != 0 else 1.0)


def standard(col: Column, stats: NumericStats) -> Column:
    """(x-mean)/population deviation; a constant column becomes 0."""
    if stats.mean is None:
        return F.lit(None).cast("double")
    return (col - F.lit(stats.mean)) / F.lit(stats.std if stats.std else 1.0)


def scale(df: DataFrame, stats: Mapping[str, NumericStats], how: Callable[[Column, NumericStats], Column]) -> DataFrame:
    return df.select(*[how(q(c).cast("double"), stats[c]).alias(c) if c in stats else q(c) for c in df.columns])


def normalise_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Divide the columns of each row by their Euclidean length; a zero row stays."""
    norm = F.sqrt(sum((q(c) * q(c) for c in names[1:]), q(names[0]) * q(names[0])))
    divisor = F.when(norm == 0, F.lit(1.0)).otherwise(norm)
    return df.select(*[(q(c) / divisor).alias(c) if c in names else q(c) for c in df.columns])


# ---------------------------------------------------------- column transformer


@dataclass(frozen=True)
class ColumnTransformer:
    """Numeric columns standardised (or min-max scaled), then categorical ones encoded.

    Output order is fixed by the spec: numeric block first, `feature_0 ..` in sequence.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    stats: dict[str, NumericStats] = field(default_factory=dict)
    vocabularies: dict[str, Vocabulary] = field(default_factory=dict)
    scaler: str = "standard"
    encoder: str = "ordinal"

    @staticmethod
    def fit(
        df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], scaler: str = "standard", encoder: str = "ordinal"
    ) -> ColumnTransformer:
        return ColumnTransformer(
            tuple(numeric), tuple(categorical), fit_numeric(df, numeric),
            fit_vocabularies(df, categorical) if categorical else {}, scaler, encoder,
        )

    def transform(self, df: DataFrame, keep: Sequence[str] = (), prefix: str | None = "feature_") -> DataFrame:
        """Kept columns, then the features; `prefix=None` keeps the original names."""
        how = minmax if self.scaler == "minmax" else standard
        out = scale(df.select(*[q(c) for c in (*keep, *self.numeric, *self.categorical)]), self.stats, how)
        if self.encoder == "onehot":
            out = one_hot(out, [self.vocabularies[c] for c in self.categorical], "ignore")
        else:
            for c in self.categorical:
                out = apply_vocabulary(out, self.vocabularies[c], "minus_one")
        features = [c for c in out.columns if c not in keep]
        new = features if prefix is None else [f"{prefix}{i}" for i in range(len(features))]
        return out.select(*[q(c) for c in keep], *[q(c).cast("double").alias(n) for c, n in zip(features, new)])

    def feature_names(self) -> list[str]:
        """Input column (or column_value) behind every output position."""
        if self.encoder != "onehot":
            return [*self.numeric, *self.categorical]
        return [*self.numeric, *[f"{c}_{v}" for c in self.categorical for v in self.vocabularies[c].values]]

    def to_json(self) -> str:
        """The fitted spec as text; only short vocabularies can be written this way."""
        if any(v.values is None for v in self.vocabularies.values()):
            raise ValueError("save long vocabularies with Vocabulary.save")
        return json.dumps({
            "numeric": self.numeric, "categorical": self.categorical,
            "stats": {c: asdict(s) for c, s in self.stats.items()},
            "vocabularies": {c: list(v.values) for c, v in self.vocabularies.items()},
            "scaler": self.scaler, "encoder": self.encoder,
        })

    @staticmethod
    def from_json(text: str) -> ColumnTransformer:
        raw = json.loads(text)
        return ColumnTransformer(
            tuple(raw["numeric"]), tuple(raw["categorical"]),
            {c: NumericStats(**s) for c, s in raw["stats"].items()},
            {c: Vocabulary(c, tuple(v)) for c, v in raw["vocabularies"].items()},
            raw["scaler"], raw["encoder"],
        )


def fit_transform(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Fit on the same rows that are transformed."""
    return ColumnTransformer.fit(df, numeric, categorical).transform(df, keep)


def encode_labels(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, Vocabulary]]:
    """Each column replaced by the position of its value in ascending order."""
    clean = drop_missing(df, names)
    vocabularies = fit_vocabularies(clean, names)
    out = clean
    for c in names:
        out = apply_vocabulary(out, vocabularies[c])
    return out, vocabularies


# --------------------------------------------------------- two-phase functions


class Analyzer:
    """What a preprocessing function may ask about the whole table.

    The function runs twice: first to note the statistics it needs (one numeric and
    one grouped job serve all of them), then with the answers to build columns.
    """

    def __init__(self) -> None:
        self._numeric: dict[str, NumericStats | None] = {}
        self._vocabularies: dict[str, Vocabulary | None] = {}
        self._joins: list[tuple[str, Vocabulary]] = []
        self._resolved = False

    def z_score(self, name: str) -> Column:
        return self._scaled(name, standard)

    def min_max(self, name: str) -> Column:
        return self._scaled(name, minmax)

    def _scaled(self, name: str, how: Callable) -> Column:
        self._numeric.setdefault(name, None)
        return how(q(name).cast("double"), self._numeric[name]) if self._resolved else F.lit(None)

    def vocabulary(self, name: str) -> Column:
        """Position by falling frequency, -1 outside the vocabulary."""
        self._vocabularies.setdefault(name, None)
        if not self._resolved:
            return F.lit(None)
        known = self._vocabularies[name]
        if known.values is not None and len(known.values) <= LITERAL_VALUES:
            return F.coalesce(_literal_index(q(name), known.values, known.dtype), F.lit(UNKNOWN))
        return q(f"_vocabulary_{name}")

    def resolve(self, df: DataFrame) -> DataFrame:
        self._numeric.update(fit_numeric(df, list(self._numeric)))
        if self._vocabularies:
            self._vocabularies.update(fit_vocabularies(df, list(self._vocabularies), "frequency"))
        self._resolved = True
        return self.attach(df)

    def attach(self, df: DataFrame) -> DataFrame:
        for name, known in self._vocabularies.items():
            if known.values is None or len(known.values) > LITERAL_VALUES:
                df = apply_vocabulary(df, known, "minus_one", f"_vocabulary_{name}", name)
        return df

    def assets(self) -> dict[str, Vocabulary]:
        return dict(self._vocabularies)


def run_preprocessing(
    df: DataFrame, function: Callable[[Analyzer], Mapping[str, Column]], keep: Sequence[str] = ()
) -> tuple[DataFrame, Analyzer]:
    """Analyse, then map every row with the user's function."""
    analyzer = Analyzer()
    function(analyzer)
    prepared = analyzer.resolve(df)
    outputs = function(analyzer)
    return prepared.select(*[q(c) for c in keep], *[col.alias(name) for name, col in outputs.items()]), analyzer


def apply_preprocessing(
    df: DataFrame, function: Callable[[Analyzer], Mapping[str, Column]], analyzer: Analyzer, keep: Sequence[str] = ()
) -> DataFrame:
    """Map new rows with statistics found earlier."""
    outputs = function(analyzer)
    return analyzer.attach(df).select(*[q(c) for c in keep], *[col.alias(name) for name, col in outputs.items()])
