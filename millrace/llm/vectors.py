"""What the vector operators share: which vectors take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def common_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length of usable vectors, the longer of equally frequent ones; 0 without any."""
    found = vectors.groupBy(F.size(column).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else 0


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares neither overflow nor vanish."""
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
