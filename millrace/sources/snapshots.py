"""Partitioned tables whose changes become visible at once, and whose updates read only what they touch.

Each write puts whole partitions below a folder of its own, and a snapshot, one small file, then
names the folder that holds each partition. Readers take the newest snapshot, so they see a
change in full or not at all, and a write that fails leaves the table as it was. A snapshot
has one entry per partition, as Spark's own file listing has. Folders of older snapshots are
kept, and can be read by number, until the owner of the table clears them.

One writer changes a table at a time; one that finds a newer snapshot than it began with fails.
A key must not move between partitions. NULL is a partition of its own.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import q
from millrace.session import fetch_bounded
from millrace.sources.tables import upsert

_VERSION = "snapshot_version"
_SNAPSHOT = "version bigint, partition string, schema string, folders array<string>"


class ChangedMeanwhile(RuntimeError):
    """Another writer has changed the table since this one began."""


def _snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_SNAPSHOT).parquet(f"{path}/snapshots")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest snapshot, 0 before the first write."""
    found = _snapshots(spark, path)
    return (found.agg(F.max("version")).first()[0] if found is not None else None) or 0


def _snapshot(spark: SparkSession, path: str, version: int | None) -> Row:
    version = newest_version(spark, path) if version is None else version
    found = _snapshots(spark, path)
    row = found.filter(F.col("version") == version).first() if found is not None else None
    if row is None:
        raise LookupError(f"{path} has no snapshot {version}")
    return row


def _rows(spark: SparkSession, path: str, snapshot: Row) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(snapshot.schema))
    if not snapshot.folders:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{f}" for f in snapshot.folders]
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*[q(c) for c in schema.names])


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a snapshot, by default the newest; filters on the partition column prune folders."""
    return _rows(spark, path, _snapshot(spark, path, version))


def _publish(df: DataFrame, path: str, partition: str, base: int, kept: Sequence[str]) -> int:
    """Write the partitions of `df` and name them, beside the folders of other partitions, in a new snapshot.

    The rebalance hint keeps a partition together and lets the adaptive plan cut one that is large
    into several files of even size.
    """
    spark, version = df.sparkSession, base + 1
    folder = f"{_VERSION}={version}"
    target = f"{path}/data/{folder}"
    # what a failed write left under this number belongs to no snapshot
    df.hint("rebalance", q(partition)).write.mode("overwrite").partitionBy(partition).parquet(target)
    files = [unquote(f).rsplit(f"{folder}/", 1)[1] for f in spark.read.schema(df.schema).parquet(target).inputFiles()]
    written = sorted({f.rsplit("/", 1)[0] for f in files})
    others = [f for f in kept if f.split("/", 1)[1] not in set(written)]
    row = (version, partition, df.schema.json(), others + [f"{folder}/{w}" for w in written])
    if newest_version(spark, path) != base:
        raise ChangedMeanwhile(f"{path} is no longer at snapshot {base}")
    spark.createDataFrame([row], _SNAPSHOT).coalesce(1).write.mode("append").parquet(f"{path}/snapshots")
    return version


def write_table(df: DataFrame, path: str, partition: str) -> int:
    """Make `df` the whole content of the table; return the number of the new snapshot."""
    if _VERSION in df.columns:
        raise ValueError(f"{_VERSION} names the folders of the table and cannot be a column")
    return _publish(df, path, partition, newest_version(df.sparkSession, path), ())


def touched_rows(table: DataFrame, changes: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions that occur in `changes`.

    Their values are fetched if they are few (the size is checked) and become a filter that the scan uses to
    leave out folders; otherwise a semi join decides.
    """
    values = changes.select(q(partition)).distinct()
    few = fetch_bounded(values)
    if few is None:
        renamed = values.select(q(partition).alias("_touched"))
        return table.join(renamed, q(partition).eqNullSafe(F.col("_touched")), "left_semi")
    known = [r[0] for r in few if r[0] is not None]
    there = q(partition).isin(known)
    return table.filter(there | q(partition).isNull() if len(known) < len(few) else there)


def upsert_table(spark: SparkSession, path: str, changes: DataFrame, key: Sequence[str], newest: str = "batch_number") -> int:
    """Merge changes into the table; return the number of the snapshot that holds them.

    Only touched partitions are read and written, once. Without changes the snapshot stays.
    """
    snapshot = _snapshot(spark, path, None)
    table = _rows(spark, path, snapshot)
    changes = changes.select(*[q(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
    if changes.isEmpty():
        return snapshot.version
    merged = upsert(touched_rows(table, changes, snapshot.partition), changes, key, newest)
    return _publish(merged.to(table.schema), path, snapshot.partition, snapshot.version, snapshot.folders)
