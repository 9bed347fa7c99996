"""Statistics, rankings and time patterns per pickup location (or any other key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.features import weekday_name
from tripmarts.functions.money import AMOUNTS, amount_mean, amount_sum
from tripmarts.operators.joins import add_zone_label
from tripmarts.operators.ranking import descending, top
from tripmarts.schemas import LOCATION

# Metric column behind each ranking.
METRICS = {"trips": "trip_count", "revenue": "total_revenue", "profit": "profit_score"}


def add_profit_score(stats: DataFrame) -> DataFrame:
    score = F.col("total_revenue") * F.col("trip_count") / 1_000_000
    return stats.withColumn("profit_score", score)


def location_stats(trips: DataFrame, location: str = LOCATION) -> DataFrame:
    """Per location: trips, mean fare, revenue, mean distance and duration, and high-value trips if they are flagged."""
    flagged = [F.sum("is_high_value").alias("high_value_trips")] if "is_high_value" in trips.columns else []
    stats = trips.groupBy(location).agg(
        F.count("*").alias("trip_count"),
        amount_mean("fare_amount").alias("avg_fare"),
        amount_sum("total_revenue").alias("total_revenue"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        *flagged,
    )
    return add_profit_score(stats)


def top_locations(stats: DataFrame, by: str = "trips", n: int = 20, location: str = LOCATION) -> DataFrame:
    """The ``n`` first locations by ``trips``, ``revenue`` or ``profit``, with their rank."""
    if by not in METRICS:
        raise ValueError(f"cannot rank by {by}: use one of {sorted(METRICS)}")
    return top(stats, METRICS[by], location, n)


def time_cells(trips: DataFrame, key: str = LOCATION) -> DataFrame:
    """Mart of trips per (key, weekday, hour), from one scan; at most 168 rows per key.

    Keeps sums and counts, so averages over any of its dimensions stay exact.
    """
    means = ["fare_amount", "total_revenue", "trip_distance", "trip_duration_minutes"]
    present = [name for name in means if name in trips.columns]
    parts = [F.count("*").alias("trips")]
    for name in present:
        total = amount_sum(name) if name in AMOUNTS else F.sum(name)
        parts += [total.alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]
    if "is_high_value" in trips.columns:
        parts.append(F.sum("is_high_value").alias("high_value_trips"))
    return trips.groupBy(key, "pickup_dayofweek", "pickup_hour").agg(*parts)


def total_of(name: str) -> Column:
    """Sum of a column of the time cells."""
    return amount_sum(f"{name}_sum") if name in AMOUNTS else F.sum(f"{name}_sum")


def mean_of(name: str) -> Column:
    """Average of a column of the time cells, weighted by its own non-NULL counts."""
    return F.try_divide(total_of(name), F.sum(f"{name}_n"))


def location_stats_from_cells(cells: DataFrame, location: str = LOCATION) -> DataFrame:
    """``location_stats`` without a second scan of the trips."""
    stats = cells.groupBy(location).agg(
        F.sum("trips").alias("trip_count"),
        mean_of("fare_amount").alias("avg_fare"),
        total_of("total_revenue").alias("total_revenue"),
        mean_of("trip_distance").alias("avg_distance"),
        mean_of("trip_duration_minutes").alias("avg_duration"),
        F.sum("high_value_trips").alias("high_value_trips"),
    )
    return add_profit_score(stats)


def busiest_patterns(
    trips: DataFrame,
    by: str,
    n: int = 5,
    key: str = LOCATION,
    metric: str = "trip_count",
) -> DataFrame:
    """Trips per value of ``by`` (an hour or weekday column) for the ``n`` first keys.

    One job for all keys: the first aggregation leaves a row per (key, value), the
    second gathers a key's values (24 or 7 of them), and only ``n`` keys go on.
    """
    if metric not in ("trip_count", "total_revenue"):
        raise ValueError(f"cannot rank by {metric}: use trip_count or total_revenue")
    parts = [F.count("*").alias("trips")]
    total = F.sum("trips")
    if metric == "total_revenue":
        parts.append(F.sum("total_revenue").alias("_revenue"))
        total = F.sum("_revenue")
    counts = trips.groupBy(key, by).agg(*parts)
    keys = counts.groupBy(key).agg(
        total.alias(metric),
        F.collect_list(F.struct(by, "trips")).alias("_pattern"),
    )
    best = keys.orderBy(*descending(keys, metric, key)).limit(n)
    return best.select(key, F.inline("_pattern"))


def temporal_patterns(
    trips: DataFrame, n: int = 5, key: str = LOCATION, hour: str = "pickup_hour", day: str = "pickup_dayofweek"
) -> DataFrame:
    """Trips per hour and per weekday of the ``n`` busiest keys: (key, pattern, value, trips).

    One scan and one aggregation of the trips, over the grouping sets (key, hour) and (key, weekday).
    """
    sets = [[F.col(key), F.col(hour)], [F.col(key), F.col(day)]]
    counts = trips.groupingSets(sets, key, hour, day).agg(
        F.count("*").alias("trips"), F.grouping(hour).alias("_by_day")
    )
    hourly = F.col("_by_day") == 0
    entry = F.struct(
        F.when(hourly, "hour").otherwise("weekday").alias("pattern"),
        F.when(hourly, F.col(hour)).otherwise(F.col(day)).alias("value"),
        "trips",
    )
    keys = counts.groupBy(key).agg(
        F.sum(F.when(hourly, F.col("trips"))).alias("trip_count"), F.collect_list(entry).alias("_patterns")
    )
    best = keys.orderBy(*descending(keys, "trip_count", key)).limit(n)
    return best.select(key, F.inline("_patterns"))


def hourly_pattern(trips: DataFrame, n: int = 5, key: str = LOCATION, metric: str = "trip_count") -> DataFrame:
    return busiest_patterns(trips, "pickup_hour", n, key, metric)


def daily_pattern(trips: DataFrame, n: int = 5, key: str = LOCATION, metric: str = "trip_count") -> DataFrame:
    pattern = busiest_patterns(trips, "pickup_dayofweek", n, key, metric)
    return pattern.withColumn("weekday", weekday_name("pickup_dayofweek"))


def labelled_hotspots(
    stats: DataFrame, zones: DataFrame, by: str = "trips", n: int = 10, location: str = LOCATION
) -> DataFrame:
    """Chart table: rank, zone label, trips, and revenue in millions. Labels only the n rows."""
    ranked = add_zone_label(top_locations(stats, by, n, location), zones, location)
    return ranked.orderBy("rank").select(
        "rank",
        location,
        "zone_label",
        "trip_count",
        (F.col("total_revenue") / 1_000_000).alias("revenue_millions"),
    )


def revenue_vs_volume(stats: DataFrame, n: int = 20, location: str = LOCATION) -> DataFrame:
    """Chart table: thousands of trips against millions of revenue for the busiest locations."""
    return top_locations(stats, "trips", n, location).select(
        "rank",
        location,
        (F.col("trip_count") / 1_000).alias("trips_thousands"),
        (F.col("total_revenue") / 1_000_000).alias("revenue_millions"),
    )
