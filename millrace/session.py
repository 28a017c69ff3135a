"""Session helpers: shared scratch space, size-checked small tables, lookups.

Every place that broadcasts or brings rows to the driver goes through
`fetch_bounded` or `SmallTable`: the size is checked first, and a table that
turns out to be too large stays distributed.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Rows that may be fetched to the driver or broadcast as one table.
SMALL_ROWS = 20_000
# Copies of an unbounded lookup table; one hot key is spread over this many tasks.
LOOKUP_SALTS = 16


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, falls
    back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    return f"{shared_dir(spark).rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back: later reads prune columns and survive executor loss."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fetch_bounded(df: DataFrame, limit: int = SMALL_ROWS) -> list[Row] | None:
    """All rows of `df` if there are at most `limit`, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


@dataclass(frozen=True)
class SmallTable:
    """A lookup table whose size has been checked.

    `rows` is set when the table fits; then `df` holds exactly those rows and may
    be broadcast. Otherwise `df` is a written table and is joined with salted keys.
    """

    df: DataFrame
    rows: tuple[Row, ...] | None

    @property
    def bounded(self) -> bool:
        return self.rows is not None

    @staticmethod
    def of(df: DataFrame, label: str = "lookup", limit: int = SMALL_ROWS) -> SmallTable:
        rows = fetch_bounded(df, limit)
        if rows is None:
            return SmallTable(materialise(df, label), None)
        return SmallTable(df.sparkSession.createDataFrame(rows, df.schema), tuple(rows))


def lookup(df: DataFrame, table: SmallTable, on: list[str], how: str = "left") -> DataFrame:
    """Join `df` with a lookup table on `on`.

    A checked small table is broadcast. A large one is joined by shuffle with the
    key salted, so a key holding a third of `df` is spread over many tasks. The salt
    is a hash of the row and not a random number, so a repeated task gives the same
    one; exact copies of a row share a salt and are left to the adaptive skew join.
    The hint keeps the large one off the driver: Spark judges it by its compressed
    file without the copies, and would broadcast many times that size.
    """
    if table.bounded:
        return df.join(F.broadcast(table.df), on, how)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(LOOKUP_SALTS))
    salts = F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1)).cast("array<bigint>"))
    left = df.withColumn("_salt", salt)
    right = table.df.withColumn("_salt", salts).hint("merge")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
