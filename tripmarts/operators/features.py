"""Derived trip columns and ML feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.features import calendar_columns, duration_minutes, flag, per_minute
from tripmarts.operators.profile import SKETCH_SIZE, exact_quantiles, quantile
from tripmarts.schemas import DROPOFF, HIGH_VALUE_QUANTILE, PICKUP


def add_time_features(df: DataFrame, pickup: str = PICKUP, dropoff: str | None = None) -> DataFrame:
    """Calendar columns, and ``trip_duration_minutes`` if there is a dropoff column."""
    if dropoff is None:
        dropoff = DROPOFF if DROPOFF in df.columns else "dropoff_datetime"
    added = calendar_columns(pickup)
    if dropoff in df.columns:
        added["trip_duration_minutes"] = duration_minutes(pickup, dropoff)
    return df.withColumns(added)


def add_revenue(df: DataFrame, fare: str = "fare_amount", tip: str = "tip_amount") -> DataFrame:
    """``total_revenue`` (fare plus tip) and, if durations exist, ``revenue_per_minute``.

    A table without fares is returned as it is.
    """
    if fare in df.columns:
        amount = F.col(fare) + F.col(tip) if tip in df.columns else F.col(fare)
        df = df.withColumn("total_revenue", amount)
    if "total_revenue" in df.columns and "trip_duration_minutes" in df.columns:
        df = df.withColumn("revenue_per_minute", per_minute("total_revenue", "trip_duration_minutes"))
    return df


def add_high_value_flag(
    df: DataFrame,
    amount: str = "total_revenue",
    fraction: float = HIGH_VALUE_QUANTILE,
    size: int = SKETCH_SIZE,
    exact: bool = True,
) -> DataFrame:
    """``is_high_value``: 1 for rows at or above the table's own quantile of ``amount``.

    The threshold is exact and found at once (``exact_quantiles``), or a sketch's in a scalar
    subquery. Both read only the columns they need. No amounts at all means no 1s.
    """
    if exact:
        (value,) = exact_quantiles(df.select(amount), [amount], [fraction], size)[amount]
        threshold = F.lit(value).cast(df.schema[amount].dataType)
    else:
        threshold = quantile(df, amount, fraction, size).scalar()
    return df.withColumn("is_high_value", flag(F.col(amount) >= threshold))


def add_trip_features(df: DataFrame, high_value: bool = True) -> DataFrame:
    """All time and revenue columns; without ``high_value`` not the flag, whose threshold takes scans of its own."""
    df = add_revenue(add_time_features(df))
    return add_high_value_flag(df) if high_value and "total_revenue" in df.columns else df


def add_location_vector(
    df: DataFrame, lat: str = "pickup_latitude", lon: str = "pickup_longitude"
) -> DataFrame:
    """Rows with usable coordinates, plus ``location_vector``; unchanged without the columns."""
    if lat not in df.columns or lon not in df.columns:
        return df
    usable = df.filter(
        F.col(lat).isNotNull() & F.col(lon).isNotNull() & (F.col(lat) != 0) & (F.col(lon) != 0)
    )
    return VectorAssembler(inputCols=[lat, lon], outputCol="location_vector").transform(usable)


def add_feature_vector(
    df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "error"
) -> DataFrame:
    """A vector of those named columns that exist.

    ``invalid`` says what a NULL does: ``error``, ``skip`` the row, or ``keep`` it as NaN.
    """
    existing = [name for name in columns if name in df.columns]
    if not existing:
        raise ValueError(f"none of these columns exist: {list(columns)}")
    assembler = VectorAssembler(inputCols=existing, outputCol=output, handleInvalid=invalid)
    return assembler.transform(df)


def vector_rows(df: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector, as the single column ``features``."""
    if vector not in df.columns:
        raise ValueError(f"no column named {vector}")
    return df.filter(F.col(vector).isNotNull()).select(F.col(vector).alias("features"))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of the columns is NULL."""
    return df.na.drop(subset=list(columns))
