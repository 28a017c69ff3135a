"""CSV files with a header."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import NA_TOKENS, q
from millrace.spec import require_columns

def _present(name: str, na_tokens: Sequence[str]) -> Column:
    return F.when(~q(name).isin(list(na_tokens)), q(name))


def _typed(field: T.StructField, na_tokens: Sequence[str]) -> Column:
    text = _present(field.name, na_tokens)
    return text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS
) -> DataFrame:
    """Typed scan with a declared schema; NA tokens become NULL in every column.

    The columns are read by header name as text and cast, so all tokens (the reader
    itself knows only one) are missing values also in numeric columns. Text that is
    no number becomes NULL as well.
    """
    raw = require_columns(read_csv_raw(spark, path), schema.names, path)
    return raw.select(*[_typed(f, na_tokens).alias(f.name) for f in schema.fields])


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, malformed rows as text): malformed when any present value does not fit its type.

    The test names every declared column, so it does not depend on the columns selected later.
    """
    raw = require_columns(read_csv_raw(spark, path), schema.names, path)
    malformed = F.lit(False)
    for f in schema.fields:
        malformed = malformed | (_present(f.name, na_tokens).isNotNull() & _typed(f, na_tokens).isNull())
    good = raw.filter(~malformed).select(*[_typed(f, na_tokens).alias(f.name) for f in schema.fields])
    return good, raw.filter(malformed)


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text under its header name, nothing inferred."""
    return spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"')


def write_csv(df: DataFrame, path: str, drop: Iterable[str] = ()) -> None:
    """Write with a header, without the dropped columns (the label of a serving sample)."""
    df.drop(*drop).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows in key order (a distributed top-n, no full sort)."""
    return df.orderBy(q(key)).limit(n)

