"""Embedding vectors as whole numbers: floor(64 * component), and exact products of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of a component's unit, and the range whole numbers are held to, so that sums of a few stay within a long.
SCALE, LIMIT = 64, 1 << 60
LONGEST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector takes part: neither null nor with a null or non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def whole(vector: Column) -> Column:
    """floor(64 * x) of each component, as longs; numbers beyond 2^60 count as 2^60."""
    held = lambda x: F.greatest(F.least(F.lit(SCALE) * x.cast("double"), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
    return F.transform(vector, lambda x: F.floor(held(x)).cast("long"))


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, whole) of the rows whose vector takes part; other columns go."""
    return df.where(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col)).alias("whole"))


def longest(vectors: DataFrame) -> int:
    """Components of the longest vector, 0 of none. Shorter ones count as continued by zeros."""
    return vectors.agg(F.max(F.size("whole"))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of longs, continued by zeros to the width."""
    rows = len(column)
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    if len(values) == rows * width:
        return values.reshape(rows, width)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((rows, width), np.int64)
    out[np.repeat(np.arange(rows), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _most(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b for longs, exact: as doubles or longs where no sum can leave their range, else as Python's integers."""
    bound = _most(a) * _most(b) * max(a.shape[1], 1)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if bound <= LONGEST:
        return a @ b
    return a.astype(object) @ b.astype(object)


def as_longs(a: np.ndarray) -> np.ndarray:
    """Numbers as longs; what a long can't hold counts as the nearest it can."""
    return np.clip(a, -LONGEST - 1, LONGEST).astype(np.int64)
