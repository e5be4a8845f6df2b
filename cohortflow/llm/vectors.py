"""Checks and conversions shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(col: str = "embedding") -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(F.col(col).isNotNull() & ~bad & F.exists(col, lambda x: x != 0), F.lit(False))


def dimensions(vectors: DataFrame, col: str = "embedding") -> int:
    """The longest vector's length; shorter ones are padded with zeros."""
    return int(vectors.agg(F.max(F.size(col))).first()[0] or 1)


def matrix(column: pd.Series, dims: int, dtype=np.float64) -> np.ndarray:
    """Rows of a vector column as a matrix, padded with zeros."""
    out = np.zeros((len(column), dims), dtype=dtype)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out
