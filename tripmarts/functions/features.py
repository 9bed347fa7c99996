"""Time and revenue expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmarts.functions.rules import whole_seconds
from tripmarts.schemas import WEEKDAYS


def calendar_columns(pickup: str) -> dict[str, Column]:
    """Hour, weekday (1 = Sunday), month, year, and the two 0/1 flags."""
    at = F.col(pickup)
    hour, weekday = F.hour(at), F.dayofweek(at)
    rush = (hour.between(7, 9) | hour.between(17, 19)) & weekday.between(2, 6)
    return {
        "pickup_hour": hour,
        "pickup_dayofweek": weekday,
        "pickup_month": F.month(at),
        "pickup_year": F.year(at),
        "is_weekend": flag(weekday.isin(1, 7)),
        "is_rush_hour": flag(rush),
    }


def duration_minutes(pickup: str, dropoff: str) -> Column:
    return whole_seconds(pickup, dropoff) / 60


def per_minute(amount: str, minutes: str) -> Column:
    """Amount per minute, 0 unless the duration is positive."""
    return F.when(F.col(minutes) > 0, F.col(amount) / F.col(minutes)).otherwise(0.0)


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def weekday_name(weekday: str) -> Column:
    """Sun..Sat for 1..7, the number itself for anything else."""
    day = F.col(weekday)
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return F.when(day.between(1, 7), F.get(names, day - 1)).otherwise(day.cast("string"))


def iso_text(at: str) -> Column:
    """ISO 8601 text; the six fraction digits appear only when they are not all 0.

    Built from the plain string form: it does not pass through the session zone.
    """
    text = F.col(at).cast("string")
    clock = F.substring(text, 12, 15)
    padded = F.when(F.length(text) > 19, F.rpad(clock, 15, "0")).otherwise(clock)
    return F.concat(F.substring(text, 1, 10), F.lit("T"), padded)
