from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmarts.operators import joins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips(spark):
    rows = [(i, None if i == 5 else i % 4, float(i)) for i in range(12)]
    return spark.createDataFrame(rows, "trip_id INT, PULocationID BIGINT, fare_amount DOUBLE")


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [(0, "A", "x"), (1, "B", "x"), (2, "C", "y")], "LocationID INT, Zone STRING, Borough STRING"
    )


def test_zones_keep_every_trip(trips, zones):
    joined = joins.join_zones(trips, zones)
    assert joined.columns == [*trips.columns, *zones.columns]
    assert joined.count() == trips.count()
    assert joined.filter("PULocationID = 3 OR PULocationID IS NULL").filter("Zone IS NOT NULL").count() == 0


def test_zones_need_both_keys(trips, zones):
    assert joins.join_zones(trips.drop("PULocationID"), zones).columns == ["trip_id", "fare_amount"]
    assert joins.join_zones(trips, zones.drop("LocationID")) is trips
    lower = zones.withColumnRenamed("LocationID", "locationid")
    assert joins.join_zones(trips, lower).count() == trips.count()


def test_small_dimension_is_broadcast(trips, zones):
    text = plan(joins.join_zones(trips, zones))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_dimension_is_shuffled(spark, trips, zones, how):
    small = joins.join_dimension(trips, zones, "PULocationID", "LocationID", how)
    large = joins.join_dimension(trips, zones, "PULocationID", "LocationID", how, max_rows=2)
    assert large.columns == small.columns
    assert large.exceptAll(small).count() == small.exceptAll(large).count() == 0
    assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
    # A column of the dimension is reached through either form.
    assert large.select(zones["Zone"]).count() == small.select(zones["Zone"]).count()


@pytest.mark.parametrize("partitions", ["8", "32"])
def test_hot_key_reaches_many_tasks(spark, zones, partitions):
    """Adaptive execution splits a key with most of the rows: no task gets it whole."""
    facts = spark.range(0, 200_000, 1, 16).select(
        F.col("id").alias("trip_id"),
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 3).cast("bigint").alias("PULocationID"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    settings = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = joins.join_dimension(facts, zones, "PULocationID", "LocationID", max_rows=0)
        own = joined.withColumn("task", F.spark_partition_id()).cache()
        parts = own.filter("PULocationID = 1").groupBy("task").count().collect()
        total = facts.filter("PULocationID = 1").count()
        assert own.count() == facts.filter("PULocationID IN (0, 1, 2)").join(zones, facts["PULocationID"] == zones["LocationID"]).count()
        own.unpersist()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in parts) == total
    assert len(parts) >= 4
    assert max(r["count"] for r in parts) < 0.6 * total


def test_size_check(zones):
    assert joins.is_small(zones)
    assert not joins.is_small(zones, max_rows=2)
    assert not joins.is_small(zones, max_bytes=10)
    assert joins.is_small(zones.filter("false"))


def test_other_join_types_are_refused(trips, zones):
    with pytest.raises(ValueError):
        joins.join_dimension(trips, zones, "PULocationID", "LocationID", "full")


def test_labels(trips, zones):
    labels = {r.trip_id: r.zone_label for r in joins.add_zone_label(trips, zones).collect()}
    assert labels[0] == "A" and labels[3] == "Loc 3" and labels[5] is None


def test_centroids_drop_unmapped(spark, trips):
    points = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 2.0)], "LocationID INT, latitude DOUBLE, longitude DOUBLE")
    joined = joins.attach_centroids(trips, points)
    assert joined.columns == [*trips.columns, "latitude", "longitude"]
    assert joined.count() == 5
