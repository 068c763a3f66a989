"""Integer vectors of an embeddings table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def integers(vector: Column, scale: int, shift: int = 0) -> Column:
    """``floor(scale * c) + shift`` of every entry, as an array of longs."""
    return F.transform(vector, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift))


def usable(vector: Column, scale: int) -> Column:
    """Not null, not empty, all entries finite and such that their integers fit 62 bits."""
    fits = F.forall(vector, lambda c: F.coalesce((F.abs(c) * scale < float(2**62)) & ~F.isnan(c), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & fits


def usual_length(rows: DataFrame, col: str) -> int | None:
    """The most frequent length of the lists (ties: the longest); None without rows."""
    first = rows.groupBy(F.size(col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return first and first.d


def matrix(col: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)
