"""Vectors with integer components: exact distances and means, in numpy inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components stay below this in absolute value, so that a squared distance fits 64 bits.
LARGEST = 1 << 26
#: Below this, sums of squares are exact in double precision for up to 256 components.
SMALL = 1 << 20


def integer_vectors(embeddings: DataFrame, scale: int, *keep: str) -> DataFrame:
    """``keep`` columns and ``point array<int>``: floor(scale * component) in double precision.

    Rows whose vector is null or holds a null or non-finite component are
    dropped. A component of ``LARGEST`` or more is an error: its distances
    would not fit 64 bits.
    """
    x = F.col("embedding").cast("array<double>")
    sound = embeddings.select(*keep, x.alias("x")).filter(
        "x is not null and not exists(x, v -> v is null or isnan(v) or abs(v) = double('infinity'))")

    def whole(v: Column) -> Column:
        y = F.floor(v * scale)
        return F.when(F.abs(v * scale) < LARGEST, y.cast("int")).otherwise(
            F.raise_error(F.lit(f"component too large: {scale} * x must stay below {LARGEST}")).cast("int"))

    return sound.select(*keep, F.transform("x", whole).alias("point"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column of ``width`` integers each as int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``y``, as int64."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) < SMALL and x.shape[1] <= 256:
        a, b = x.astype(np.float64), y.astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        return d.astype(np.int64)
    out = np.empty((len(x), len(y)), np.int64)
    for j, row in enumerate(y):
        out[:, j] = ((x - row) ** 2).sum(1)
    return out


def sums_by(group: np.ndarray, x: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the rows of ``x`` per group; exact in double precision for some millions of rows at a time."""
    member = (group[None, :] == np.arange(groups)[:, None]).astype(np.float64)
    return (member @ x.astype(np.float64)).astype(np.int64)


def floor_means(old: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """floor(sum / count) per component; where the count is 0 the old values stay."""
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], old)
