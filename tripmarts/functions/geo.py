"""Squared distances, and the report bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Center = tuple[int, Sequence[float]]


def squared_distance(columns: Sequence[str], point: Sequence[float]) -> Column:
    parts = [
        (F.col(name) - F.lit(float(value))) * (F.col(name) - F.lit(float(value)))
        for name, value in zip(columns, point, strict=True)
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def silhouette_band(score: str) -> Column:
    value = F.col(score)
    return (
        F.when(value > 0.5, "excellent")
        .when(value > 0.25, "good")
        .when(value > 0, "weak")
        .otherwise("poor")
    )


def fare_tier(fare: str) -> Column:
    value = F.col(fare)
    return F.when(value > 25, "airport").when(value > 15, "high").otherwise("regular")


def revenue_color(revenue: str) -> Column:
    value = F.col(revenue)
    return F.when(value > 1_000_000, "red").when(value > 500_000, "orange").otherwise("blue")


def marker_size(trips: str) -> Column:
    return F.least(F.lit(20.0) + F.col(trips) / 1000, F.lit(50.0))
