"""Top-k selection with a total order, so equal values never swap places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def descending(df: DataFrame, metric: str, key: str) -> list[Column]:
    """Sort order: metric from high to low, NULLs last, then key.

    Floating sums differ in their last digits with the order of the tasks, so they
    are compared after rounding.
    """
    value = F.col(metric)
    if isinstance(df.schema[metric].dataType, (T.DoubleType, T.FloatType)):
        value = F.round(value, 6)
    return [value.desc_nulls_last(), F.col(key).asc_nulls_first()]


def top(df: DataFrame, metric: str, key: str, n: int) -> DataFrame:
    """The ``n`` highest rows with their ``rank`` from 1.

    The limit runs first (each task keeps n rows), so the window that numbers
    them sees n rows at most.
    """
    order = descending(df, metric, key)
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
