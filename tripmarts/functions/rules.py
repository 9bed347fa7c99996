"""Row validity rules. Each returns a boolean column that is true for rows to keep.

The rules are plain comparisons, so a filter built from them reaches the Parquet
scan. A NULL operand makes a rule NULL, and a filter drops the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmarts.schemas import CITY_BOUNDS, MAX_FARE, MAX_TRIP_HOURS, Bounds


def all_of(rules: Sequence[Column]) -> Column:
    return reduce(and_, rules, F.lit(True))


def coordinates_ok(lat: str, lon: str, bounds: Bounds = CITY_BOUNDS) -> Column:
    """Both present, inside the inclusive bounds, and neither exactly 0."""
    return all_of([
        F.col(lat).isNotNull(),
        F.col(lon).isNotNull(),
        F.col(lat).between(bounds.lat_min, bounds.lat_max),
        F.col(lon).between(bounds.lon_min, bounds.lon_max),
        F.col(lat) != 0,
        F.col(lon) != 0,
    ])


def whole_seconds(start: str, end: str) -> Column:
    """Difference of the two times, each first cut to its whole second."""
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))


def times_ok(pickup: str, dropoff: str, max_hours: float = MAX_TRIP_HOURS) -> Column:
    """Pickup strictly before dropoff, and not more than ``max_hours`` apart."""
    return all_of([
        F.col(pickup).isNotNull(),
        F.col(dropoff).isNotNull(),
        F.col(pickup) < F.col(dropoff),
        whole_seconds(pickup, dropoff) / 3600 <= max_hours,
    ])


def values_ok(
    columns: Sequence[str],
    *,
    passengers: str = "passenger_count",
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    min_passengers: float = 0,
    min_distance: float = 0,
    min_fare: float = 0,
    max_fare: float | None = None,
) -> Column:
    """Rules for those of the three value columns that exist.

    Fares must be positive. The fare limit applies when ``max_fare`` is given; a
    table with fares but no distances is limited to 500 even when it is not.
    """
    rules = []
    if passengers in columns:
        rules += [F.col(passengers).isNotNull(), F.col(passengers) >= min_passengers]
    if distance in columns:
        rules += [F.col(distance).isNotNull(), F.col(distance) >= min_distance]
    if fare in columns:
        limit = MAX_FARE if max_fare is None and distance not in columns else max_fare
        rules += [F.col(fare).isNotNull(), F.col(fare) > 0]
        if min_fare > 0:
            rules.append(F.col(fare) >= min_fare)
        if limit is not None:
            rules.append(F.col(fare) <= limit)
    return all_of(rules)
