"""Tables: create, replace, append, upsert, read; JDBC options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import null_tokens, q
from millrace.session import materialise
from millrace.spec import TABLES

JDBC_BATCH = 15_000


def create_table(
    spark: SparkSession, name: str, schema: T.StructType | None = None, location: str | None = None, reset: bool = False
) -> None:
    """CREATE TABLE IF NOT EXISTS with declared columns; `reset` drops it first.

    Without `schema` the declared schema of that name is used.
    """
    if reset:
        drop_table(spark, name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (schema or TABLES[name]).fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def server_info(spark: SparkSession) -> DataFrame:
    """One row: time, database, user and version of the engine behind the session."""
    return spark.range(1).select(
        F.current_timestamp().alias("now"), F.current_database().alias("database"),
        F.current_user().alias("user"), F.version().alias("version"),
    )


def replace_table(df: DataFrame, path: str, expected: int | None = None) -> int:
    """Overwrite the table at `path`; return its row count, checked against `expected`."""
    df.write.mode("overwrite").parquet(path)
    return _verified(_stored_rows(df.sparkSession, path, df.schema), expected, path)


def append_table(df: DataFrame, path: str, expected: int | None = None) -> int:
    """Append to the table at `path`; return the number of rows added, checked against `expected`.

    Row counts come from the file footers, not from reading the rows.
    """
    spark = df.sparkSession
    before = _stored_rows(spark, path, df.schema)
    df.write.mode("append").parquet(path)
    return _verified(_stored_rows(spark, path, df.schema) - before, expected, path)


def _verified(stored: int, expected: int | None, path: str) -> int:
    if expected is not None and stored != expected:
        raise RuntimeError(f"{path}: expected {expected} rows, stored {stored}")
    return stored


def _stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    try:
        return spark.read.schema(schema).parquet(path).count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def skip_empty_rows(df: DataFrame, token: str = "?", ignore: Sequence[str] = ()) -> DataFrame:
    """The missing marker becomes NULL; rows without any value are left out."""
    cleaned = null_tokens(df, (token,))
    return cleaned.dropna(how="all", subset=[c for c in cleaned.columns if c not in ignore])


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    return not isinstance(kind, T.MapType | T.VariantType)


def latest_per_key(df: DataFrame, key: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the largest `newest` expressions, of equal ones that with the largest other columns.

    An aggregate with a partial step, so many versions of one key shrink before the shuffle. Maps cannot be
    compared, so rows that differ in a map only are equal here and either stays.
    """
    others = [c for c in df.columns if c not in key]
    ties = [q(f.name) for f in df.schema if f.name in others and _comparable(f.dataType)]
    best = F.max_by(F.struct(*[q(c) for c in others]), F.struct(*newest, *ties)).alias("r")
    return df.groupBy(*[q(c) for c in key]).agg(best).select(*[q(c) for c in key], "r.*").select(*[q(c) for c in df.columns])


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str], newest: str = "batch_number") -> DataFrame:
    """Current rows replaced by changes with the same key; of several the highest `newest` wins.

    A change beats the current row of the same number, and of changes with one number the row whose other columns
    are larger (compared in their order) wins, so reruns agree.
    """
    both = current.withColumn("_change", F.lit(0)).unionByName(changes.withColumn("_change", F.lit(1)))
    return latest_per_key(both, key, [q(newest), q("_change")]).drop("_change")


def upsert_partitions(
    spark: SparkSession, path: str, changes: DataFrame, key: Sequence[str], partition: str, newest: str = "batch_number"
) -> None:
    """Merge changes into a partitioned table, rewriting only the partitions they touch.

    The merged rows are written to the shared folder first, because a table cannot be
    overwritten while it is read. A key must not move between partitions.
    """
    current = spark.read.parquet(path)
    touched = changes.select(q(partition)).distinct()
    old = current.join(touched, partition, "left_semi").select(*current.columns)
    merged = materialise(upsert(old, changes.select(*current.columns), key, newest), "merged")
    (
        merged.repartition(q(partition), F.pmod(F.xxhash64(*[q(c) for c in key]), F.lit(8)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


# ---------------------------------------------------------------------- JDBC


def jdbc_read_options(
    url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1,
    fetch: int = JDBC_BATCH, driver: str | None = None,
) -> dict[str, str]:
    """Options of a partitioned read: one range of `column` per task."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch)}
    if driver:
        options["driver"] = driver
    if column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **how) -> DataFrame:
    """Scan of a database table; filters, columns and limits are pushed into its SQL."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **how)).load()


def jdbc_write_options(url: str, table: str, partitions: int = 8, batch: int = JDBC_BATCH, driver: str | None = None) -> dict[str, str]:
    """Options of a batched write: `batch` rows per statement, `partitions` connections."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch), "numPartitions": str(partitions)}
    return options | ({"driver": driver} if driver else {})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **how) -> None:
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **how)).save()
