from __future__ import annotations

import math

import pytest

from pyspark.sql import functions as F
from tripmarts.functions import money
from tripmarts.operators import locations, ranking

TRIPS = """PULocationID BIGINT, fare_amount DOUBLE, total_revenue DOUBLE, trip_distance DOUBLE,
    trip_duration_minutes DOUBLE, is_high_value INT, pickup_hour INT, pickup_dayofweek INT"""


@pytest.fixture(scope="module")
def trips(spark):
    rows = [
        (1, 10.0, 12.0, 1.0, 5.0, 1, 8, 2),
        (1, 20.0, None, None, 5.0, 0, 8, 3),
        (1, None, 5.0, 3.0, None, 0, 9, 2),
        (2, 5.0, 6.0, 1.0, 4.0, 0, 9, 2),
        (2, 5.0, 6.0, 1.0, 4.0, 0, 10, 2),
        (2, 5.0, 6.0, 1.0, 4.0, 1, 10, 7),
        (None, 1.0, 1.0, 1.0, 1.0, 0, 1, 1),
        (3, 50.0, 60.0, 1.0, 1.0, 1, None, None),
    ]
    return spark.createDataFrame(rows, TRIPS)


def test_stats(trips):
    rows = {r.PULocationID: r for r in locations.location_stats(trips).collect()}
    one = rows[1]
    assert (one.trip_count, one.avg_fare, one.total_revenue, one.avg_distance) == (3, 15.0, 17.0, 2.0)
    assert (one.avg_duration, one.high_value_trips) == (5.0, 1)
    assert one.profit_score == pytest.approx(17.0 * 3 / 1e6)
    assert set(rows) == {1, 2, 3, None}


def test_cells_give_the_same_stats(trips):
    direct = locations.location_stats(trips)
    cells = locations.location_stats_from_cells(locations.time_cells(trips))
    assert cells.columns == direct.columns
    assert cells.exceptAll(direct).count() == direct.exceptAll(cells).count() == 0


def test_equal_counts_order_by_id(trips):
    best = locations.top_locations(locations.location_stats(trips), "trips", 3)
    assert [(r["rank"], r.PULocationID) for r in best.orderBy("rank").collect()] == [(1, 1), (2, 2), (3, None)]
    with pytest.raises(ValueError):
        locations.top_locations(locations.location_stats(trips), "fame")


def test_summation_noise_does_not_order(spark):
    df = spark.createDataFrame([(2, 0.1 + 0.2), (1, 0.3), (3, None)], "id INT, x DOUBLE")
    assert [r.id for r in ranking.top(df, "x", "id", 3).orderBy("rank").collect()] == [1, 2, 3]


def test_patterns(trips):
    rows = locations.hourly_pattern(trips, 2).collect()
    assert {(r.PULocationID, r.pickup_hour, r.trips) for r in rows} == {
        (1, 8, 2), (1, 9, 1), (2, 9, 1), (2, 10, 2)
    }
    days = locations.daily_pattern(trips, 2).collect()
    assert {(r.PULocationID, r.weekday, r.trips) for r in days} == {
        (1, "Mon", 2), (1, "Tue", 1), (2, "Mon", 2), (2, "Sat", 1)
    }
    by_revenue = locations.hourly_pattern(trips, 1, metric="total_revenue").collect()
    assert [(r.PULocationID, r.pickup_hour, r.trips) for r in by_revenue] == [(3, None, 1)]
    with pytest.raises(ValueError):
        locations.hourly_pattern(trips, metric="avg_fare")


def test_labels(spark, trips):
    zones = spark.createDataFrame([(1, "A", "x")], "LocationID INT, Zone STRING, Borough STRING")
    stats = locations.location_stats(trips)
    rows = locations.labelled_hotspots(stats, zones, n=2).orderBy("rank").collect()
    assert [(r.zone_label, r.trip_count, r.revenue_millions) for r in rows] == [
        ("A", 3, 17.0 / 1e6), ("Loc 2", 3, 18.0 / 1e6)
    ]
    chart = locations.revenue_vs_volume(stats, 1).first()
    assert (chart["rank"], chart.trips_thousands, chart.revenue_millions) == (1, 0.003, 17.0 / 1e6)


def test_amounts_without_a_limit(spark):
    values = [10.0, 20.0, 2e14, 0.12345, 1e19, 0.1 + 0.2, 5e-324]
    df = spark.createDataFrame([(1, v) for v in values] + [(1, None), (2, 1.0), (2, float("nan")), (3, float("inf")), (3, 2.0), (4, None)], "k INT, v DOUBLE")
    both = df.groupBy("k").agg(
        money.amount_sum("v").alias("s"), money.amount_mean("v").alias("m"), F.sum("v").alias("plain"), F.avg("v").alias("avg")
    )
    found = {r.k: r for r in both.collect()}
    assert found[1].s == pytest.approx(found[1].plain, rel=1e-12) and found[1].m == pytest.approx(found[1].avg, rel=1e-12)
    assert math.isnan(found[2].m) and found[3].m == float("inf") and found[4].m is None and found[4].s is None


def test_small_amounts_are_exact_in_any_order(spark):
    df = spark.range(20_000).selectExpr("1 AS k", "id * 0.1 + 0.00001 AS v")
    sums = {df.repartition(n).groupBy("k").agg(money.amount_sum("v").alias("s")).first().s for n in (1, 3, 8)}
    assert sums == {19999000.2}
