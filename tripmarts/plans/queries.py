"""Queries over the test tables, one per operator; see ``oracles.py`` for the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.functions import money
from tripmarts.operators import cleaning, clusters, features, joins, kmeans, locations, profile, sampling
from tripmarts.runtime import cut_lineage, stored, work_path
from tripmarts.schemas import LOCATION, Bounds
from tripmarts.sources import messages, star, tables
from tripmarts.streaming import sinks
from tripmarts.streaming import trips as live

Query = Callable[[SparkSession, str], DataFrame]

# Narrower than the city, so that some zones fall outside.
DISTRICT = Bounds(40.53, 40.74, -74.15, -73.86)
# Fixed centres: the points of the zones 0, 5, 10 and 15.
CENTERS = [(0, (40.5, -74.2)), (1, (40.575, -74.1)), (2, (40.65, -74.0)), (3, (40.725, -73.9))]
# Longest order-to-shipment time that counts as valid, in hours.
ORDER_HOURS = 90 * 24

# Batches of a paced stream, and the most messages of a file of it.
BATCHES = 5
MESSAGES_PER_FILE = 1_000_000

TRIP_MESSAGE = """
    trip_id BIGINT, tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING, PULocationID BIGINT,
    passenger_count DOUBLE, trip_distance DOUBLE, fare_amount DOUBLE, tip_amount DOUBLE
"""

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded: the last digits of a sum depend on the order of its rows."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, digits) for name in doubles})


# ---- inputs -------------------------------------------------------------------------


def valid_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Event trips that pass the time and value rules; event ids are unique already."""
    return cleaning.filter_values(cleaning.filter_times(star.event_trips(spark, folder)))


def featured_trips(spark: SparkSession, folder: str, high_value: bool = True) -> DataFrame:
    return features.add_trip_features(valid_trips(spark, folder), high_value)


def located_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Event trips with the coordinates of their zone, NULL without one."""
    points = star.nation_centroids(spark, folder).select(
        F.col("LocationID").alias("zone_id"),
        F.col("latitude").alias("pickup_latitude"),
        F.col("longitude").alias("pickup_longitude"),
    )
    trips = star.event_trips(spark, folder)
    return joins.join_dimension(trips, points, "PULocationID", "zone_id", "left").drop("zone_id")


def repeated(trips: DataFrame) -> DataFrame:
    """The trips, and those with a tip once more."""
    return trips.unionByName(trips.filter(F.col("tip_amount") > 0))


def dirty_trips(spark: SparkSession, folder: str) -> DataFrame:
    return repeated(located_trips(spark, folder))


def clustered_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Featured trips with the coordinates and pinned cluster of their zone."""
    zones = clusters.zone_clusters(star.nation_centroids(spark, folder), CENTERS)
    trips = features.add_revenue(features.add_time_features(valid_trips(spark, folder)))
    return clusters.attach_clusters(trips, zones)


def location_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Time cells per location, computed once, with the pinned cluster of their zone."""
    trips = features.add_revenue(features.add_time_features(valid_trips(spark, folder)))
    zones = clusters.zone_clusters(star.nation_centroids(spark, folder), CENTERS)
    return clusters.attach_clusters(cut_lineage(locations.time_cells(trips)), zones)


def zone_points(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.zone_points(valid_trips(spark, folder), star.nation_centroids(spark, folder))


def trip_points(spark: SparkSession, folder: str) -> DataFrame:
    return joins.attach_centroids(
        valid_trips(spark, folder), star.nation_centroids(spark, folder)
    ).select("trip_id", "PULocationID", "latitude", "longitude")


def centers(spark: SparkSession) -> DataFrame:
    return kmeans.centers_table(spark, CENTERS)


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_metrics(clustered_trips(spark, folder))


def valid_orders(spark: SparkSession, folder: str) -> DataFrame:
    trips = star.order_trips(spark, folder)
    return cleaning.filter_values(cleaning.filter_times(trips, max_hours=ORDER_HOURS))


def flagged_stats(trips: DataFrame) -> DataFrame:
    """Location statistics of derived trips, which are computed once: the exact threshold takes scans of its own."""
    trips = features.add_trip_features(trips, high_value=False)
    used = [LOCATION, "fare_amount", "total_revenue", "trip_distance", "trip_duration_minutes"]
    return locations.location_stats(features.add_high_value_flag(stored(trips.select(*used), "trips")))


# ---- sources and sinks --------------------------------------------------------------


@query
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_trips(spark, f"{folder}/events.parquet")


@query
def scan_drifted(spark: SparkSession, folder: str) -> DataFrame:
    """Trips in three sets of files: later ones lack a column, have a new one, and other types."""
    path = work_path(spark, "drifted")
    trips = star.event_trips(spark, folder).drop("tpep_dropoff_datetime")
    month = F.col("trip_id") % 3
    first = trips.filter(month == 0).withColumns({"passenger_count": F.col("passenger_count").cast("int")})
    second = trips.filter(month == 1).drop("tip_amount").withColumn("airport_fee", (F.col("trip_id") % 5).cast("int"))
    third = trips.filter(month == 2).withColumn("airport_fee", F.col("trip_id") % 7 / 4)
    for name, part in (("m1", first), ("m2", second), ("m3", third)):
        tables.write_table(part, f"{path}/{name}")
    return tables.read_drifted(spark, path)


@query
def audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    expected = ["events.parquet", "orders.parquet", "lineitem.parquet", "taxi.parquet"]
    audit = tables.audit_rows(spark, folder, expected)
    return audit.groupBy("table").agg(F.sum("n_rows").alias("n_rows"), F.max("is_present").alias("is_present"))


@query
def write_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "roundtrip")
    tables.write_table(star.event_trips(spark, folder), path)
    return tables.read_table(spark, path)


@query
def dataset_info(spark: SparkSession, folder: str) -> DataFrame:
    info = profile.dataset_info(star.event_trips(spark, folder))
    return info.select("row_count", "column_count", F.array_join("columns", ",").alias("columns"))


@query
def trip_json(spark: SparkSession, folder: str) -> DataFrame:
    return live.parse_messages(
        messages.to_messages(star.event_trips(spark, folder)), TRIP_MESSAGE
    )


# ---- cleaning and profile -----------------------------------------------------------


@query
def clean_coords(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.filter_coordinates(located_trips(spark, folder), bounds=DISTRICT)


@query
def clean_times(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.filter_times(star.event_trips(spark, folder), max_hours=1.5)


@query
def clean_values(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.filter_values(star.event_trips(spark, folder))


@query
def clean_values_capped(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.filter_values(
        star.event_trips(spark, folder), min_passengers=1, min_distance=0.5, min_fare=5, max_fare=100
    )


@query
def clean_values_fare_only(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.filter_values(star.event_trips(spark, folder).drop("trip_distance"))


@query
def dedup_all(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_duplicates(repeated(star.event_trips(spark, folder)))


@query
def dedup_rare(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_rare_duplicates(repeated(star.event_trips(spark, folder)))


@query
def dedup_key(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_duplicates(
        repeated(star.event_trips(spark, folder)), ["PULocationID", "passenger_count"]
    )


@query
def clean_trips(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_trips(dirty_trips(spark, folder), bounds=DISTRICT)


@query
def clean_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.cleaning_report(dirty_trips(spark, folder), bounds=DISTRICT))


@query
def clean_summary(spark: SparkSession, folder: str) -> DataFrame:
    report = cleaning.cleaning_report(dirty_trips(spark, folder), bounds=DISTRICT)
    return rounded(cleaning.cleaning_summary(report))


@query
def order_clean_report(spark: SparkSession, folder: str) -> DataFrame:
    trips = star.order_trips(spark, folder)
    return rounded(cleaning.cleaning_report(trips, max_hours=ORDER_HOURS))


@query
def quality_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.null_profile(dirty_trips(spark, folder)))


@query
def quality_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.numeric_profile(dirty_trips(spark, folder), exact=True))


@query
def quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.quality_profile(tables.read_table(spark, f"{folder}/lineitem.parquet"), exact=True))


@query
def drop_null_features(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["pickup_latitude", "pickup_longitude", "fare_amount", "passenger_count"]
    return features.drop_incomplete(located_trips(spark, folder), columns)


# ---- features and joins -------------------------------------------------------------


@query
def temporal_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_time_features(star.event_trips(spark, folder)).select(
        "trip_id",
        "pickup_hour",
        "pickup_dayofweek",
        "pickup_month",
        "pickup_year",
        "is_weekend",
        "is_rush_hour",
    )


@query
def trip_duration(spark: SparkSession, folder: str) -> DataFrame:
    timed = features.add_time_features(star.event_trips(spark, folder))
    return timed.select("trip_id", "trip_duration_minutes")


@query
def revenue_features(spark: SparkSession, folder: str) -> DataFrame:
    timed = features.add_time_features(star.event_trips(spark, folder))
    return features.add_revenue(timed).select("trip_id", "total_revenue", "revenue_per_minute")


@query
def high_value_flag(spark: SparkSession, folder: str) -> DataFrame:
    return featured_trips(spark, folder).select("trip_id", "is_high_value")


@query
def location_vector(spark: SparkSession, folder: str) -> DataFrame:
    vectors = features.add_location_vector(located_trips(spark, folder))
    point = vector_to_array("location_vector")
    return vectors.select("trip_id", F.get(point, F.lit(0)).alias("x"), F.get(point, F.lit(1)).alias("y"))


@query
def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    trips = star.event_trips(spark, folder)
    columns = ["fare_amount", "tip_amount", "trip_distance", "no_such_column"]
    rows = features.vector_rows(features.add_feature_vector(trips, columns), "features")
    parts = vector_to_array("features")
    return rows.select(
        F.size(parts).alias("dimensions"),
        *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(["fare", "tip", "distance"])],
    )


@query
def zone_enrich(spark: SparkSession, folder: str) -> DataFrame:
    trips = star.event_trips(spark, folder).select("trip_id", "PULocationID", "fare_amount")
    return joins.join_zones(trips, star.nation_zones(spark, folder))


@query
def zone_enrich_large(spark: SparkSession, folder: str) -> DataFrame:
    """The same join as for a dimension above the broadcast limit: both sides are shuffled."""
    return joins.join_dimension(
        star.event_trips(spark, folder).select("trip_id", "PULocationID", "fare_amount"),
        star.nation_zones(spark, folder),
        "PULocationID",
        "LocationID",
        "left",
        max_rows=0,
    )


@query
def centroid_map(spark: SparkSession, folder: str) -> DataFrame:
    trips = valid_trips(spark, folder).select("trip_id", "PULocationID", "fare_amount")
    return joins.attach_centroids(trips, star.nation_centroids(spark, folder))


# ---- locations ----------------------------------------------------------------------


@query
def location_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(locations.location_stats(featured_trips(spark, folder)))


@query
def amount_extremes(spark: SparkSession, folder: str) -> DataFrame:
    """Sums and means of amounts with five decimals, of 1e14 and more, and NaN in one group."""
    price = F.round("l_extendedprice")
    amount = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), F.lit(float("nan")))
        .when(F.col("l_linenumber") == 6, price * 1e10)
        .when(F.col("l_linenumber") == 5, price / 100_000)
        .when(F.col("l_linenumber") < 5, F.col("l_extendedprice"))
    )
    rows = star.table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", amount.alias("amount"))
    found = rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("amount").alias("amounts"), (money.amount_sum("amount") / 1e12).alias("trillions"),
        (money.amount_mean("amount") / 1e6).alias("mean_millions"),
    )
    return rounded(found, 6)


@query
def location_stats_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    cells = locations.time_cells(featured_trips(spark, folder))
    return rounded(locations.location_stats_from_cells(cells))


@query
def clean_location_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Clean with duplicates removed, features, zone names, location statistics, top 20."""
    trips = cleaning.clean_trips(repeated(star.event_trips(spark, folder)))
    best = locations.top_locations(flagged_stats(trips), "trips", 20)
    return rounded(joins.join_zones(best, star.nation_zones(spark, folder)))


@query
def order_location_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flagged_stats(valid_orders(spark, folder)))


@query
def order_hotspot_labels(spark: SparkSession, folder: str) -> DataFrame:
    trips = features.add_trip_features(valid_orders(spark, folder), high_value=False)
    stats = locations.location_stats(trips)
    return rounded(
        locations.labelled_hotspots(stats, star.supplier_zones(spark, folder), "revenue", 20)
    )


@query
def top_by_trips(spark: SparkSession, folder: str) -> DataFrame:
    return _top(spark, folder, "trips")


@query
def top_by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return _top(spark, folder, "revenue")


@query
def top_by_profit(spark: SparkSession, folder: str) -> DataFrame:
    return _top(spark, folder, "profit")


def _top(spark: SparkSession, folder: str, by: str) -> DataFrame:
    stats = locations.location_stats(featured_trips(spark, folder))
    return rounded(locations.top_locations(stats, by, 20))


@query
def hourly_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return locations.hourly_pattern(features.add_time_features(valid_trips(spark, folder)))


@query
def daily_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return locations.daily_pattern(features.add_time_features(valid_trips(spark, folder)))


@query
def temporal_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return locations.temporal_patterns(features.add_time_features(valid_trips(spark, folder)))


@query
def hotspot_labels(spark: SparkSession, folder: str) -> DataFrame:
    stats = locations.location_stats(featured_trips(spark, folder, high_value=False))
    labelled = locations.labelled_hotspots(stats, star.nation_zones(spark, folder))
    return rounded(labelled, 6)


@query
def revenue_vs_volume(spark: SparkSession, folder: str) -> DataFrame:
    stats = locations.location_stats(featured_trips(spark, folder, high_value=False))
    return rounded(locations.revenue_vs_volume(stats), 6)


# ---- clusters -----------------------------------------------------------------------


@query
def nearest_center(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.assign_nearest(trip_points(spark, folder), CENTERS)


@query
def cluster_attach(spark: SparkSession, folder: str) -> DataFrame:
    return clustered_trips(spark, folder).select(
        "trip_id", "PULocationID", "latitude", "longitude", "cluster"
    )


@query
def cluster_counts(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_counts(clustered_trips(spark, folder))


@query
def cluster_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.cluster_stats(clustered_trips(spark, folder)))


@query
def cluster_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics(spark, folder))


@query
def cluster_stats_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.cluster_stats_from_cells(location_cells(spark, folder)))


@query
def cluster_metrics_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.cluster_metrics_from_cells(location_cells(spark, folder)))


@query
def peak_hour(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.peak_hours(clustered_trips(spark, folder))


@query
def location_peak_hour(spark: SparkSession, folder: str) -> DataFrame:
    trips = features.add_time_features(valid_trips(spark, folder))
    return clusters.peak_hours(trips, "PULocationID")


@query
def cluster_hourly_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return locations.hourly_pattern(clustered_trips(spark, folder), 3, "cluster", "total_revenue")


@query
def cluster_daily_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return locations.daily_pattern(clustered_trips(spark, folder), 3, "cluster", "total_revenue")


@query
def rank_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.rank_clusters(metrics(spark, folder), "revenue", 10))


@query
def rank_count(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.rank_clusters(metrics(spark, folder), "count", 10))


@query
def rank_avg_fare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.rank_clusters(metrics(spark, folder), "avg_fare", 10))


@query
def rank_combined(spark: SparkSession, folder: str) -> DataFrame:
    # The maxima are read from the finished metrics, not from the trips again.
    return rounded(clusters.rank_clusters(cut_lineage(metrics(spark, folder)), "combined", 10))


@query
def hotspot_report(spark: SparkSession, folder: str) -> DataFrame:
    report = clusters.hotspot_report(location_cells(spark, folder), centers(spark))

    def text(pattern: str) -> Column:
        """A map of at most 24 entries as key:value pairs in key order."""
        pairs = F.transform(
            F.array_sort(F.map_entries(pattern)),
            lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string")),
        )
        return F.array_join(pairs, ",")

    return rounded(report.withColumns({"hourly": text("hourly"), "daily": text("daily")}))


@query
def cluster_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_distribution(clusters.cluster_counts(clustered_trips(spark, folder)))


@query
def fare_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Tiers per location: their mean fares differ more than the clusters'."""
    stats = locations.location_stats(featured_trips(spark, folder, high_value=False))
    return rounded(clusters.fare_tiers(stats, "PULocationID"))


@query
def map_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clusters.map_points(metrics(spark, folder), centers(spark)))


@query
def bar_feed(spark: SparkSession, folder: str) -> DataFrame:
    ranked = clusters.rank_clusters(metrics(spark, folder), "revenue", 10)
    return rounded(clusters.bar_feed(ranked))


# ---- K-Means ------------------------------------------------------------------------


@query
def distinct_points(spark: SparkSession, folder: str) -> DataFrame:
    return zone_points(spark, folder)


@query
def wssse_pinned(spark: SparkSession, folder: str) -> DataFrame:
    assigned = clusters.assign_nearest(zone_points(spark, folder), CENTERS)
    return rounded(kmeans.wssse(assigned), 6)


@query
def silhouette_pinned(spark: SparkSession, folder: str) -> DataFrame:
    assigned = clusters.assign_nearest(zone_points(spark, folder), CENTERS)
    return rounded(kmeans.silhouette(assigned), 6)


@query
def silhouette_held_out(spark: SparkSession, folder: str) -> DataFrame:
    """Plain distances, over the trips of the test part."""
    held_out = trip_points(spark, folder).filter(sampling.in_test_part(["trip_id"]))
    assigned = clusters.assign_nearest(kmeans.distinct_points(held_out), CENTERS)
    return rounded(kmeans.euclidean_silhouette(assigned), 6)


@query
def kmeans_all_points(spark: SparkSession, folder: str) -> DataFrame:
    """With more centres than points every point is a centre, and the cost is 0."""
    model = kmeans.fit_all_rows(zone_points(spark, folder), 100)
    found = kmeans.centers_table(spark, kmeans.centers_of(model)).drop("cluster")
    return rounded(found.withColumn("wssse", F.lit(float(model.summary.trainingCost))), 6)


@query
def kmeans_full(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on all trips, then statistics of the fitted clusters, from one scan."""
    trips = features.add_revenue(features.add_time_features(valid_trips(spark, folder)))
    cells = cut_lineage(locations.time_cells(trips))
    points = star.nation_centroids(spark, folder)
    model = kmeans.fit_all_rows(kmeans.zone_points(cells, points), 5)
    zones = clusters.zone_clusters(points, kmeans.centers_of(model))
    return clusters.cluster_stats_from_cells(clusters.attach_clusters(cells, zones))


@query
def kmeans_centers(spark: SparkSession, folder: str) -> DataFrame:
    model = kmeans.fit_all_rows(zone_points(spark, folder), 5)
    return kmeans.centers_table(spark, kmeans.centers_of(model))


@query
def kmeans_elbow(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.elbow(zone_points(spark, folder), (5, 10, 15, 20), selected=10)


@query
def kmeans_validation(spark: SparkSession, folder: str) -> DataFrame:
    report, _ = kmeans.validate(trip_points(spark, folder), ["trip_id"], 5)
    return report


# ---- sampling -----------------------------------------------------------------------


@query
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.hash_sample(star.event_trips(spark, folder), ["trip_id"], 0.1)


@query
def sample_10000(spark: SparkSession, folder: str) -> DataFrame:
    """The validation sample of a fixed size."""
    return sampling.fixed_sample(star.event_trips(spark, folder), ["trip_id"], 10_000)


@query
def random_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.random_sample(star.event_trips(spark, folder), 0.1)


@query
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """Every trip once, with the part it falls into."""
    train, test = sampling.hash_split(star.event_trips(spark, folder), ["trip_id"])
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("trip_id", "part")


# ---- streaming ----------------------------------------------------------------------


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """The trips as a stream of JSON messages, read from files the cluster shares."""
    path = work_path(spark, "messages")
    tables.write_table(messages.to_messages(star.event_trips(spark, folder)), path)
    return live.message_stream(spark, "parquet", path)


def _appended(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path, checkpoint = work_path(spark, "stream"), work_path(spark, "checkpoint")
    sinks.to_table(df, path, checkpoint, sinks.DONE).awaitTermination()
    return tables.read_table(spark, path)


def _running(df: DataFrame) -> DataFrame:
    """The last running result; it has a row per cluster, or ten rows."""
    spark = df.sparkSession
    path, checkpoint = work_path(spark, "snapshots"), work_path(spark, "checkpoint")
    sinks.to_snapshots(df, path, checkpoint, sinks.DONE, files=1).awaitTermination()
    return sinks.latest_snapshot(spark, path, df.schema)


@query
def stream_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _appended(live.parse_messages(_messages(spark, folder), TRIP_MESSAGE))


@query
def stream_scored(spark: SparkSession, folder: str) -> DataFrame:
    trips = live.parse_messages(_messages(spark, folder), TRIP_MESSAGE)
    scored = live.score_with_centers(trips, star.nation_centroids(spark, folder), CENTERS)
    return _appended(scored.select("trip_id", "PULocationID", "latitude", "longitude", "cluster"))


@query
def stream_cluster_counts(spark: SparkSession, folder: str) -> DataFrame:
    trips = live.parse_messages(_messages(spark, folder), TRIP_MESSAGE)
    scored = live.score_with_centers(trips, star.nation_centroids(spark, folder), CENTERS)
    return _running(clusters.cluster_counts(scored))


@query
def stream_top_locations(spark: SparkSession, folder: str) -> DataFrame:
    trips = live.parse_messages(_messages(spark, folder), TRIP_MESSAGE)
    return _running(live.running_top_locations(trips))


def _paced(spark: SparkSession, trips: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    """The trips as a stream of BATCHES batches, malformed messages as one more; files grow in number with the table."""
    each = -(-trips.count() // (BATCHES * MESSAGES_PER_FILE)) or 1
    path = work_path(spark, "messages")
    tables.write_table(messages.to_messages(trips).repartition(BATCHES * each), path)
    if malformed is not None:
        malformed.repartition(each).write.mode("append").parquet(path)
    return live.message_stream(spark, "parquet", path, {"maxFilesPerTrigger": str(each)})


@query
def stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The pace of the stream: its batches, their rows, and whether none has over twice the rows of another."""
    path = work_path(spark, "pace")
    stream = _paced(spark, star.event_trips(spark, folder))
    sinks.to_batch_counts(stream, path, work_path(spark, "checkpoint"), sinks.DONE).awaitTermination()
    return spark.read.parquet(path).agg(
        F.count("*").alias("n_batches"),
        F.max("batch").alias("last_batch"),
        F.sum("n_rows").alias("n_rows"),
        (F.max("n_rows") <= 2 * F.min("n_rows")).alias("is_even"),
    )


@query
def stream_model_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A model fitted on four zones, saved, loaded, and applied to the trips of several batches."""
    points = star.nation_centroids(spark, folder)
    path = work_path(spark, "model")
    kmeans.save_model(kmeans.fit_all_rows(points.filter(F.col("LocationID").isin(0, 5, 10, 15)), 4), path)
    model = kmeans.load_model(path)
    counts = _running(live.live_counts(_paced(spark, star.event_trips(spark, folder)), points, model))
    found = kmeans.centers_table(spark, kmeans.centers_of(model))
    return rounded(counts.join(found, "cluster").select("latitude", "longitude", "trip_count"), 6)


@query
def stream_live_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Top locations over six batches, the last one malformed, with the full message schema."""
    trips = star.event_trips(spark, folder)
    broken = trips.filter(F.col("tip_amount") > 0).select(F.concat(F.lit("no trip "), F.col("trip_id")).alias("value"))
    return _running(live.live_counts(_paced(spark, trips, broken)))
