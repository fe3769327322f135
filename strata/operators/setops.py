"""Set operations on distinct values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def values_outside(df: DataFrame, column: str, expected: DataFrame | Iterable) -> DataFrame:
    """Distinct non-null values of ``column`` not in ``expected`` (a
    DataFrame whose first column holds the allowed values, or a list),
    sorted. With a DataFrame this is a ``left_anti`` join (``EXCEPT``)."""
    values = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    if isinstance(expected, DataFrame):
        allowed = expected.select(F.col(expected.columns[0]).alias("value")).distinct()
        return values.join(allowed, "value", "left_anti").orderBy("value")
    return values.filter(~F.col("value").isin(list(expected))).orderBy("value")


def label_union(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """Sorted distinct union of two label columns (truth and prediction)."""
    return (a.select(F.col(a_col).alias("label")).union(b.select(F.col(b_col).alias("label")))
            .filter(F.col("label").isNotNull()).distinct().orderBy("label"))
