"""Projection, filtering and cleaning as column expressions (no job is started here)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens read as missing in delimited text.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
CLIP_BOUND = 1e10


def q(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating columns: the two forms one missing value takes."""
    col = q(name)
    return col.isNull() | F.isnan(col) if is_float(df, name) else col.isNull()


def select_present(df: DataFrame, names: Iterable[str], case_sensitive: bool = True) -> DataFrame:
    """The named columns that exist, in the order asked for."""
    by_name = {c if case_sensitive else c.lower(): c for c in df.columns}
    found = [by_name.get(n if case_sensitive else n.lower()) for n in names]
    return df.select(*[q(c) for c in found if c is not None])


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None, dash_to_underscore: bool = False) -> DataFrame:
    """Rename columns in one projection."""
    mapping = mapping or {}
    new = [mapping.get(c, c) for c in df.columns]
    return df.toDF(*[c.replace("-", "_") if dash_to_underscore else c for c in new])


def enumerate_features(df: DataFrame, features: Iterable[str], prefix: str = "feature_", start: int = 0) -> DataFrame:
    """Rename `features` to prefix0, prefix1, ... keeping the other columns."""
    mapping = {c: f"{prefix}{i}" for i, c in enumerate(features, start)}
    return df.toDF(*[mapping.get(c, c) for c in df.columns])


def drop_missing(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Keep rows where none of the columns is missing."""
    for name in names if names is not None else df.columns:
        df = df.filter(~is_missing(df, name))
    return df


def drop_sentinel(df: DataFrame, name: str, sentinel: str) -> DataFrame:
    """Drop rows holding the sentinel; rows with NULL stay; no-op when the column is absent."""
    if name not in df.columns:
        return df
    return df.filter(~q(name).eqNullSafe(F.lit(sentinel)))


def null_tokens(df: DataFrame, tokens: Iterable[str] = ("?",), names: Iterable[str] | None = None) -> DataFrame:
    """Tokens in string columns become NULL."""
    tokens = list(tokens)
    chosen = set(names) if names is not None else None
    return df.select(*[
        F.when(~q(f.name).isin(tokens), q(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) and (chosen is None or f.name in chosen)
        else q(f.name)
        for f in df.schema.fields
    ])


def fill_groups(df: DataFrame, groups: Iterable[tuple[Iterable[str], object]]) -> DataFrame:
    """Fill missing values, each group of columns with its own value."""
    fills = {name: value for names, value in groups for name in names}
    return df.select(*[
        F.when(is_missing(df, c), F.lit(fills[c])).otherwise(q(c)).alias(c) if c in fills else q(c)
        for c in df.columns
    ])


def to_number(col: Column) -> Column:
    """Text to double; text that is no number becomes NULL."""
    return col.try_cast("double")


def infinite_to_zero(col: Column) -> Column:
    """NULL, NaN and both infinities become 0."""
    bad = col.isNull() | F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(col)


def clip(col: Column, bound: float = CLIP_BOUND) -> Column:
    """Limit to [-bound, bound]; NULL stays NULL and NaN, which compares as the largest number, NaN."""
    return F.when((col > bound) & ~F.isnan(col), F.lit(bound)).when(col < -bound, F.lit(-bound)).otherwise(col)


def clip_large(df: DataFrame, names: Iterable[str], bound: float = CLIP_BOUND) -> tuple[DataFrame, dict[str, float]]:
    """Clip the columns whose largest magnitude exceeds the bound; also return those magnitudes.

    One aggregate over all columns decides, so untouched columns keep their plain scan.
    """
    names = list(names)
    top = max_abs(df, names).first()
    over = {c: top[c] for c in names if top[c] is not None and top[c] > bound}
    return df.select(*[clip(q(c), bound).alias(c) if c in over else q(c) for c in df.columns]), over


def max_abs(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The largest magnitude of each column; missing values are left out."""
    return df.agg(*[F.max(F.when(~is_missing(df, c), F.abs(q(c)))).alias(c) for c in names])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types; columns outside the schema are left out."""
    return df.select(*[q(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def binary_label(col: Column, positive: Iterable[str], yes: str = "YES", no: str = "NO") -> Column:
    """`yes` for the positive values, `no` for all others and for NULL."""
    return F.when(col.isin(list(positive)), F.lit(yes)).otherwise(F.lit(no))


def total_of(*cols: Column) -> Column:
    """Sum of columns; a missing part makes the sum missing."""
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def missing_counts(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """(column, n_missing, any_missing): one aggregate, turned to long form."""
    names = list(names if names is not None else df.columns)
    wide = df.agg(*[
        F.coalesce(F.sum(is_missing(df, c).cast("bigint")), F.lit(0)).alias(f"m{i}") for i, c in enumerate(names)
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(names)
    ])
    return (
        wide.select(F.explode(rows).alias("r"))
        .select("r.column", "r.n_missing", (F.col("r.n_missing") > 0).alias("any_missing"))
    )


def json_records(df: DataFrame, names: Iterable[str] | None = None, out: str = "record") -> DataFrame:
    """Each row as one JSON object; NaN and infinities are written as null."""
    names = list(names if names is not None else df.columns)
    fields = []
    for name in names:
        col = q(name)
        if is_float(df, name):
            bad = F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
            col = F.when(~bad, col)
        fields.append(col.alias(name))
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(out))
