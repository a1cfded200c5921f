"""Vectors in Arrow batches: which of them take part, and their matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null, empty or zero and holds no null or non-finite component."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.where(F.col(vector).isNotNull() & F.forall(vector, real) & F.exists(vector, lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Float64 rows of a list column of one length."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed alike for equal rows wherever they stand."""
    return (a * b).sum(axis=1)
