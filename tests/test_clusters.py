from __future__ import annotations

import pytest

from tripmarts.operators import clusters, locations

CENTERS = [(0, (0.0, 0.0)), (1, (2.0, 0.0)), (7, (0.0, 10.0))]


@pytest.fixture(scope="module")
def trips(spark):
    rows = [
        (1, 0, 0.0, 0.0, 30.0, 30.0, 4.0, 8, 2),
        (2, 0, 0.0, 0.0, 10.0, 20.0, 4.0, 9, 2),
        (3, 1, 2.0, 0.0, 20.0, 20.0, None, 9, 3),
        (4, 1, 2.0, 0.0, None, None, 4.0, None, None),
        (5, 1, 2.0, 1.0, 5.0, 5.0, 4.0, 7, 3),
    ]
    return spark.createDataFrame(
        rows,
        """trip_id INT, cluster INT, latitude DOUBLE, longitude DOUBLE, fare_amount DOUBLE,
        total_revenue DOUBLE, trip_duration_minutes DOUBLE, pickup_hour INT, pickup_dayofweek INT""",
    )


def test_nearest(spark):
    points = spark.createDataFrame(
        [(1, 1.0, 0.0), (2, 1.1, 0.0), (3, None, 0.0), (4, 0.0, 9.0)], "i INT, latitude DOUBLE, longitude DOUBLE"
    )
    rows = {r.i: (r.cluster, r.distance) for r in clusters.assign_nearest(points, CENTERS).collect()}
    assert rows[1] == (0, 1.0)
    assert rows[2][0] == 1
    assert rows[3] == (None, None)
    assert rows[4] == (7, 1.0)


@pytest.mark.parametrize("k", [1, 25, 26, 120])
def test_nearest_of_many(spark, k):
    """Any number of centres, in any order, with repeated ones: as by brute force."""
    centers = [(i, ((i * 37 % 60) / 10, (i * 11 % 60) / 10)) for i in range(k)]
    points = [(i, i % 60 / 10, i * 7 % 61 / 10) for i in range(300)]
    df = spark.createDataFrame(points, "i INT, latitude DOUBLE, longitude DOUBLE")
    rows = clusters.assign_nearest(df, centers[::-1]).collect()
    for row in rows:
        best = min(
            ((row.latitude - x) * (row.latitude - x) + (row.longitude - y) * (row.longitude - y), c)
            for c, (x, y) in centers
        )
        assert (row.distance, row.cluster) == best


def test_attach_keeps_one_row_per_trip(spark):
    """Zones that share a point and trips that share a zone do not multiply."""
    zones = clusters.zone_clusters(
        spark.createDataFrame(
            [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 2.0, 0.0)], "LocationID INT, latitude DOUBLE, longitude DOUBLE"
        ),
        CENTERS,
    )
    trips = spark.createDataFrame([(i, i % 5) for i in range(20)], "trip_id INT, PULocationID BIGINT")
    inner = clusters.attach_clusters(trips, zones)
    assert inner.count() == 12
    assert clusters.attach_clusters(trips, zones, how="left").count() == 20
    counts = {r.cluster: r.trip_count for r in clusters.cluster_counts(inner).collect()}
    assert counts == {0: 8, 1: 4}


def test_metrics(trips):
    rows = {r.cluster: r for r in clusters.cluster_metrics(trips).collect()}
    assert tuple(rows[0])[1:] == (2, 20.0, 25.0, 50.0, 4.0, 8.5)
    assert tuple(rows[1])[1:] == (3, 12.5, 12.5, 25.0, 4.0, 8.0)


def test_cells_give_the_same_statistics(trips):
    cells = locations.time_cells(trips, "cluster")
    direct = clusters.cluster_metrics(trips)
    assert direct.exceptAll(clusters.cluster_metrics_from_cells(cells)).count() == 0
    placed = trips.withColumnRenamed("cluster", "PULocationID").drop("latitude", "longitude")
    points = placed.sparkSession.createDataFrame(
        [(0, 0.0, 0.0), (1, 2.0, 0.0)], "LocationID INT, latitude DOUBLE, longitude DOUBLE"
    )
    zones = clusters.zone_clusters(points, CENTERS)
    by_trip = clusters.cluster_stats(clusters.attach_clusters(placed, zones))
    by_cell = clusters.cluster_stats_from_cells(
        clusters.attach_clusters(locations.time_cells(placed), zones)
    )
    assert by_trip.exceptAll(by_cell).count() == by_cell.exceptAll(by_trip).count() == 0


def test_peak_hour_tie_goes_to_the_earlier(trips):
    rows = {r.cluster: r.peak_hour for r in clusters.peak_hours(trips.na.drop(subset=["pickup_hour"])).collect()}
    assert rows == {0: 8, 1: 7}


def test_rankings(trips):
    metrics = clusters.cluster_metrics(trips)

    def order(by):
        return [r.cluster for r in clusters.rank_clusters(metrics, by, 5).orderBy("rank").collect()]

    assert order("revenue") == [0, 1]
    assert order("count") == [1, 0]
    assert order("avg_fare") == [0, 1]
    assert order("combined") == [0, 1]
    assert [r.cluster for r in clusters.rank_clusters(metrics, "count").collect()] == [1, 0]
    scores = {r.cluster: r.profitability_score for r in clusters.add_combined_score(metrics).collect()}
    assert scores == {0: pytest.approx(2 / 3), 1: pytest.approx(12.5 / 20)}
    with pytest.raises(ValueError):
        clusters.rank_clusters(metrics, "luck")


def test_combined_score_of_zero_fares(spark):
    metrics = spark.createDataFrame([(0, 5, 0.0)], "cluster INT, trip_count BIGINT, avg_fare DOUBLE")
    assert clusters.add_combined_score(metrics).first().profitability_score is None


def test_report(spark, trips):
    points = spark.createDataFrame([(0, 0.5, 0.5)], "cluster INT, latitude DOUBLE, longitude DOUBLE")
    cells = locations.time_cells(trips, "cluster")
    rows = {r.cluster: r for r in clusters.hotspot_report(cells, points).collect()}
    assert rows[0]["rank"] == 1 and rows[0].hourly == {8: 1, 9: 1} and rows[0].daily == {2: 2}
    assert (rows[0].latitude, rows[1].latitude) == (0.5, None)
    assert rows[1].hourly == {7: 1, 9: 1}


@pytest.mark.parametrize(("fare", "tier"), [(25.0, "high"), (25.01, "airport"), (15.0, "regular"), (15.01, "high")])
def test_fare_tiers(spark, fare, tier):
    stats = spark.createDataFrame([(0, 1, fare)], "cluster INT, trip_count BIGINT, avg_fare DOUBLE")
    assert clusters.fare_tiers(stats).first().tier == tier


def test_map_points(spark):
    metrics = spark.createDataFrame(
        [(0, 30_000, 1_000_000.0, 1.0), (1, 29_500, 1_000_000.5, 1.0), (2, 40_000, 500_000.0, 1.0), (3, 99, 1.0, 1.0)],
        "cluster INT, trip_count BIGINT, total_revenue DOUBLE, avg_fare DOUBLE",
    )
    points = spark.createDataFrame(
        [(0, 1.0, 1.0), (1, 1.0, 1.0), (2, 1.0, 1.0)], "cluster INT, latitude DOUBLE, longitude DOUBLE"
    )
    rows = {r.cluster: (r.radius, r.color) for r in clusters.map_points(metrics, points).collect()}
    assert rows == {0: (50.0, "orange"), 1: (49.5, "red"), 2: (50.0, "blue")}


def test_bar_feed(trips):
    ranked = clusters.rank_clusters(clusters.cluster_metrics(trips), "revenue", 10)
    rows = clusters.bar_feed(ranked).orderBy("rank").collect()
    assert [(r.label, r.value) for r in rows] == [("Cluster 0", 50.0), ("Cluster 1", 25.0)]
    assert {r.value for r in clusters.bar_feed(ranked, "no_such_metric").collect()} == {0.0}
