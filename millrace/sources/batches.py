"""JSON batch envelopes and landed group files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import q

POSITIONAL_SCHEMA = T.StructType([
    T.StructField("group_number", T.IntegerType()),
    T.StructField("batch_number", T.IntegerType()),
    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
])


def read_positional(
    spark: SparkSession, path: str, names: Sequence[str], types: dict[str, str] | None = None, multiline: bool = False
) -> DataFrame:
    """Envelopes `{group_number, batch_number, data: [[v, ..], ..]}` as one row per inner array.

    Positions become the given names; `batch_number` is added to each row.
    """
    envelopes = spark.read.schema(POSITIONAL_SCHEMA).option("multiLine", multiline).json(path)
    return explode_positional(envelopes, names, types)


def explode_positional(envelopes: DataFrame, names: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """The same for a table (or stream) of parsed envelopes."""
    types = types or {}
    rows = envelopes.select("batch_number", F.explode("data").alias("r"))
    cells = [F.get("r", F.lit(i)).try_cast(types.get(c, "string")).alias(c) for i, c in enumerate(names)]
    return rows.select(*cells, "batch_number")


def records_schema(record: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("batch_number", T.IntegerType()), T.StructField("start_row", T.LongType()),
        T.StructField("end_row", T.LongType()), T.StructField("batch_size", T.IntegerType()),
        T.StructField("data", T.ArrayType(record)),
    ])


def read_records(spark: SparkSession, path: str, record: T.StructType, whole_file: bool = False) -> DataFrame:
    """Documents that are `{.., data: [{..}, ..]}` or a bare list `[{..}, ..]`.

    One document per line, or per file with `whole_file`. An empty list gives no rows.
    """
    text = spark.read.text(path, wholetext=whole_file)
    return parse_records(text, "value", record)


def parse_records(df: DataFrame, column: str, record: T.StructType) -> DataFrame:
    """Rows of both document forms held in a text column."""
    enveloped = F.from_json(q(column), records_schema(record)).getField("data")
    bare = F.from_json(q(column), T.ArrayType(record))
    is_list = F.ltrim(q(column)).startswith("[")
    rows = F.explode(F.when(is_list, bare).otherwise(enveloped))
    return df.select(rows.alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def to_positional(df: DataFrame, names: Sequence[str], batch: Column, group: Column | None = None) -> DataFrame:
    """Rows gathered into positional envelopes, one per batch.

    `batch` must bound the rows of one envelope, as a page number does.
    """
    inner = F.array(*[q(c).cast("string") for c in names])
    return (
        df.select(batch.cast("int").alias("batch_number"), (F.lit(1) if group is None else group).cast("int").alias("group_number"), inner.alias("r"))
        .groupBy("group_number", "batch_number")
        .agg(F.collect_list("r").alias("data"))
    )


def to_records(df: DataFrame, names: Sequence[str], batch: Column, size: int) -> DataFrame:
    """Rows gathered into record envelopes of one page each."""
    return (
        df.select(batch.cast("int").alias("batch_number"), F.struct(*[q(c) for c in names]).alias("r"))
        .groupBy("batch_number")
        .agg(F.collect_list("r").alias("data"))
        .select(
            "batch_number",
            (F.col("batch_number").cast("bigint") * size).alias("start_row"),
            (F.col("batch_number").cast("bigint") * size + F.size("data")).alias("end_row"),
            F.size("data").alias("batch_size"),
            "data",
        )
    )


# ------------------------------------------------------------------- landing


def land_groups(df: DataFrame, group: str, path: str) -> None:
    """Write one JSON folder per group.

    The rebalance hint brings a group together; the adaptive plan cuts a large partition of the shuffle into several
    tasks and joins small ones in one, so the number of files follows the bytes. Small groups in a
    partition that is cut are cut with it, so partitions should be as many as the bytes ask for.
    """
    df.hint("rebalance", q(group)).write.mode("overwrite").partitionBy(group).json(path)


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows with `source_file`, quarantined text with `source_file`).

    One JSON object per line, or per file with `multiline`. Text that does not fit the
    schema does not fail the read. The whole object is always parsed, so what counts
    as broken does not depend on the columns selected later.
    """
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = (
        spark.read.text(path, wholetext=multiline)
        .filter(F.trim("value") != "")
        .select(F.col("_metadata.file_path").alias("source_file"), "value", F.from_json("value", wide, options).alias("r"))
    )
    broken = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    good = parsed.filter(~broken).select(*[F.col("r").getField(c).alias(c) for c in schema.names], "source_file")
    return good, parsed.filter(broken).select("source_file", F.col("value").alias("text"))
