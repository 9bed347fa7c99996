"""What the physical plans must look like."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmarts.operators import cleaning, clusters, features, kmeans, locations, profile
from tripmarts.plans import queries
from tripmarts.sources import tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as it ran: stages that were reused show up only then."""
    df.collect()
    return plan(df).split("+- == Initial Plan ==")[0]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """A stored trip table with the usual column names."""
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    extra = queries.located_trips(spark, FOLDER).withColumns(
        {"VendorID": F.lit(1).cast("bigint"), "store_and_fwd_flag": F.lit("N")}
    )
    extra.drop("pickup_latitude", "pickup_longitude").write.parquet(path)
    return tables.read_table(spark, path)


def test_rules_reach_the_scan(raw):
    text = plan(cleaning.filter_values(raw).select("fare_amount"))
    pushed = text.split("PushedFilters: ")[1]
    assert "GreaterThan(fare_amount,0.0)" in pushed
    assert "GreaterThanOrEqual(trip_distance,0.0)" in pushed
    assert "IsNotNull(passenger_count)" in pushed


def test_cleaning_is_one_filter_and_one_shuffle(raw):
    text = plan(cleaning.clean_trips(raw))
    assert text.count("FileScan") == 1
    assert text.count("Exchange ") == 1
    assert text.count("Filter ") == 1


def test_report_reads_once(raw):
    assert plan(cleaning.cleaning_report(raw)).count("FileScan") == 1
    after = plan(cleaning.cleaning_report(raw, cleaned=raw))
    scan = next(line for line in after.split("\n") if "FileScan" in line and "fare_amount" in line)
    assert "store_and_fwd_flag" not in scan and "VendorID" not in scan


def test_profile_reads_once(raw):
    text = plan(profile.quality_profile(raw))
    assert text.count("FileScan") == 1
    # Sketches meet by partition, twice in groups of partitions, and once over the groups.
    assert text.count("Exchange ") == 4


def test_statistics_read_few_columns(raw):
    text = plan(locations.location_stats(features.add_trip_features(raw)))
    assert "store_and_fwd_flag" not in text and "VendorID" not in text
    assert "partial_count" in text


def test_pattern_is_one_scan(raw):
    text = plan(locations.hourly_pattern(features.add_time_features(raw)))
    assert text.count("FileScan") == 1 and "TakeOrderedAndProject" in text
    assert "tip_amount" not in text


def test_top_is_not_a_sort(raw):
    stats = locations.location_stats(features.add_revenue(features.add_time_features(raw)).withColumn("is_high_value", F.lit(0)))
    text = plan(locations.top_locations(stats))
    assert "TakeOrderedAndProject" in text


def test_attached_clusters_broadcast_the_zones(spark):
    text = plan(queries.clustered_trips(spark, FOLDER))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_silhouette_counts_points_once(spark):
    trips = queries.trip_points(spark, FOLDER)
    text = final_plan(kmeans.silhouette(clusters.assign_nearest(trips, queries.CENTERS)))
    assert "ReusedExchange" in text


@pytest.mark.parametrize("query", [queries.order_location_stats, queries.clean_location_stats])
def test_derived_trips_are_computed_once_for_the_flag(spark, query):
    text = final_plan(query(spark, FOLDER))
    assert "lineitem.parquet" not in text and "orders.parquet" not in text and "events.parquet" not in text
