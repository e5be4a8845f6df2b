"""Score helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(arr) -> Column:
    """0-based index of the largest element of an array; first max wins."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c)))


def sigmoid_score(raw_prediction) -> Column:
    """Sigmoid of the positive-class logit of an ML ``rawPrediction`` vector."""
    from pyspark.ml.functions import vector_to_array

    return sigmoid(F.element_at(vector_to_array(_col(raw_prediction)), 2))


def assert_finite(df: DataFrame, column: str) -> DataFrame:
    """Fail the job on a NaN/NULL/infinite value in ``column`` (a loss)."""
    c = F.col(column)
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return df.withColumn(
        column,
        F.when(bad, F.raise_error(F.concat(F.lit(f"non-finite {column}: "), c.cast("string"))))
        .otherwise(c),
    )
