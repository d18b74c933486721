"""Vectors as Spark holds them and as tasks use them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector is not null, empty or zero, and all its components are finite."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ~odd & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of doubles from lists of one length."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaling by the largest component first keeps tiny and huge rows from vanishing."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True) if rows.size else rows
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None] if rows.size else rows
