"""Integer vectors: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Integers up to this size are doubles without rounding.
EXACT = 1 << 53


def integer_vectors(table: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The rows of ``table`` whose vector is whole, with ``x``: floor(scale * entry) of each.

    Entries are read as doubles.  A null or empty vector, or one with a null or non-finite
    entry, is left out, as are vectors of another length than most (of two lengths that are
    equally frequent the greater counts).  An input column ``x`` is replaced.
    """
    whole = table.filter((F.size(vector) > 0) & F.forall(vector, lambda c: (
        c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))))
    lengths = whole.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    length = lengths[0]["d"] if lengths else 0
    return whole.filter(F.size(vector) == length).withColumn(
        "x", F.transform(vector, lambda c: F.floor(c.cast("double") * scale)))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length as an int64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def largest(x: np.ndarray) -> int:
    """The greatest absolute value, 0 of nothing."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integer matrices, exact: as doubles where no sum rounds, else as whole numbers."""
    bound = a.shape[1] * largest(a) * largest(b)
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64)
    return a.astype(object) @ b.astype(object)
