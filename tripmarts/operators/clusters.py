"""Statistics and rankings of clustered trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.geo import Center, fare_tier, marker_size, revenue_color, squared_distance
from tripmarts.functions.money import amount_mean, amount_sum
from tripmarts.operators.joins import join_dimension
from tripmarts.operators.locations import mean_of, total_of
from tripmarts.operators.ranking import descending, top
from tripmarts.schemas import LOCATION

POINT = ("latitude", "longitude")
# Centres compared per projection, to keep the generated code short.
CENTERS_PER_STEP = 25

# Metric column behind each ranking.
RANKINGS = {
    "revenue": "total_revenue",
    "count": "trip_count",
    "avg_fare": "avg_fare",
    "combined": "profitability_score",
}


def assign_nearest(
    df: DataFrame,
    centers: Sequence[Center],
    columns: Sequence[str] = POINT,
    cluster: str = "cluster",
) -> DataFrame:
    """Cluster id and squared ``distance`` of each row's nearest centre.

    ``centers`` is the short list a fitted model holds: the distances are plain
    expressions over the row, without a join. Equal distances go to the lower id; a
    NULL coordinate leaves both columns NULL. Beyond some 50 centres the JVM no longer
    compiles the expressions: score many rows with the model itself then.
    """
    ordered = sorted((int(i), point) for i, point in centers)
    found = df.withColumns({
        "_distance": F.lit(None).cast("double"), "_cluster": F.lit(None).cast("int")
    })
    for start in range(0, len(ordered), CENTERS_PER_STEP):
        step = ordered[start : start + CENTERS_PER_STEP]
        ids = F.array(*[F.lit(i) for i, _ in step])
        distances = F.array(*[squared_distance(columns, point) for _, point in step])
        closer = F.col("_distance").isNull() | (F.col("_near") < F.col("_distance"))
        found = (
            found.withColumn("_distances", distances)
            .withColumns({
                "_near": F.array_min("_distances"),
                "_place": F.array_position("_distances", F.array_min("_distances")).cast("int"),
            })
            .withColumns({
                "_distance": F.when(closer, F.col("_near")).otherwise(F.col("_distance")),
                "_cluster": F.when(closer, F.get(ids, F.col("_place") - 1)).otherwise(F.col("_cluster")),
            })
        )
    named = found.withColumns({cluster: F.col("_cluster"), "distance": F.col("_distance")})
    return named.drop("_distance", "_cluster", "_distances", "_near", "_place")


def zone_clusters(centroids: DataFrame, centers: Sequence[Center], cluster: str = "cluster") -> DataFrame:
    """The zone dimension with its cluster: a trip's cluster depends on its zone alone."""
    return assign_nearest(centroids, centers, POINT, cluster).drop("distance")


def attach_clusters(
    trips: DataFrame, zones: DataFrame, location: str = LOCATION, how: str = "inner"
) -> DataFrame:
    """Trips with the coordinates and cluster of their zone; one row per trip.

    ``zones`` comes from ``zone_clusters``: distances are computed once per zone,
    not per trip, and the ids are unique, so no trip is repeated.
    """
    points = zones.withColumnRenamed("LocationID", "_zone_id")
    return join_dimension(trips, points, location, "_zone_id", how).drop("_zone_id")


def cluster_counts(trips: DataFrame, cluster: str = "cluster") -> DataFrame:
    return trips.groupBy(cluster).agg(F.count("*").alias("trip_count"))


def cluster_stats(trips: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster: trips, mean position, mean fare and mean revenue."""
    return trips.groupBy(cluster).agg(
        F.count("*").alias("trip_count"),
        F.avg("latitude").alias("center_lat"),
        F.avg("longitude").alias("center_lon"),
        amount_mean("fare_amount").alias("avg_fare"),
        amount_mean("total_revenue").alias("avg_revenue"),
    )


def cluster_metrics(trips: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster: trips, mean fare, mean and total revenue, mean duration and pickup hour."""
    return trips.groupBy(cluster).agg(
        F.count("*").alias("trip_count"),
        amount_mean("fare_amount").alias("avg_fare"),
        amount_mean("total_revenue").alias("avg_revenue"),
        amount_sum("total_revenue").alias("total_revenue"),
        F.avg("trip_duration_minutes").alias("avg_duration_minutes"),
        F.avg("pickup_hour").alias("avg_hour"),
    )


def cluster_stats_from_cells(cells: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster_stats`` from time cells with coordinates and a cluster."""
    trips = F.sum("trips")
    return cells.groupBy(cluster).agg(
        trips.alias("trip_count"),
        (F.sum(F.col("latitude") * F.col("trips")) / trips).alias("center_lat"),
        (F.sum(F.col("longitude") * F.col("trips")) / trips).alias("center_lon"),
        mean_of("fare_amount").alias("avg_fare"),
        mean_of("total_revenue").alias("avg_revenue"),
    )


def cluster_metrics_from_cells(cells: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster_metrics`` from time cells that carry a cluster: no second scan of the trips."""
    hours = F.when(F.col("pickup_hour").isNotNull(), F.col("trips"))
    return cells.groupBy(cluster).agg(
        F.sum("trips").alias("trip_count"),
        mean_of("fare_amount").alias("avg_fare"),
        mean_of("total_revenue").alias("avg_revenue"),
        total_of("total_revenue").alias("total_revenue"),
        mean_of("trip_duration_minutes").alias("avg_duration_minutes"),
        F.try_divide(F.sum(F.col("pickup_hour") * F.col("trips")), F.sum(hours)).alias("avg_hour"),
    )


def peak_hours(trips: DataFrame, cluster: str = "cluster", hour: str = "pickup_hour") -> DataFrame:
    """The hour with most trips per cluster; of equal hours the earliest."""
    counts = trips.groupBy(cluster, hour).agg(F.count("*").alias("trips"))
    return busiest_hour(counts, cluster, hour)


def busiest_hour(counts: DataFrame, cluster: str = "cluster", hour: str = "pickup_hour") -> DataFrame:
    """As ``peak_hours``, from rows that hold ``trips`` per cluster and hour."""
    order = F.struct(-F.col("trips"), F.col(hour))
    return counts.groupBy(cluster).agg(F.min_by(hour, order).alias("peak_hour"))


def add_combined_score(metrics: DataFrame) -> DataFrame:
    """Trips over the highest trips, times mean fare over the highest mean fare.

    NULL if a maximum is 0. The maxima are scalar subqueries over the clusters.
    """
    most = metrics.agg(F.max("trip_count")).scalar()
    dearest = metrics.agg(F.max("avg_fare")).scalar()
    score = F.try_divide(F.col("trip_count"), most) * F.try_divide(F.col("avg_fare"), dearest)
    return metrics.withColumn("profitability_score", score)


def rank_clusters(
    metrics: DataFrame, by: str = "revenue", n: int | None = None, cluster: str = "cluster"
) -> DataFrame:
    """Clusters from the first to the last by one ranking; with ``n``, that many and their rank."""
    if by not in RANKINGS:
        raise ValueError(f"cannot rank by {by}: use one of {sorted(RANKINGS)}")
    if by == "combined":
        metrics = add_combined_score(metrics)
    if n is not None:
        return top(metrics, RANKINGS[by], cluster, n)
    return metrics.orderBy(*descending(metrics, RANKINGS[by], cluster))


def cluster_patterns(cells: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster: maps of trips per hour and per weekday, and the peak hour."""

    def pattern(by: str) -> DataFrame:
        counts = cells.groupBy(cluster, by).agg(F.sum("trips").alias("trips"))
        entries = F.sort_array(F.collect_list(F.struct(by, "trips")))
        known = F.filter(entries, lambda e: e[by].isNotNull())
        return counts.groupBy(cluster).agg(
            F.map_from_entries(known).alias(by),
            F.min_by(by, F.struct(-F.col("trips"), F.col(by))).alias(f"_peak_{by}"),
        )

    hours = pattern("pickup_hour").withColumnsRenamed(
        {"pickup_hour": "hourly", "_peak_pickup_hour": "peak_hour"}
    )
    days = pattern("pickup_dayofweek").withColumnRenamed("pickup_dayofweek", "daily")
    return hours.join(days.drop("_peak_pickup_dayofweek"), cluster)


def hotspot_report(
    cells: DataFrame, centers: DataFrame, by: str = "revenue", n: int = 10, cluster: str = "cluster"
) -> DataFrame:
    """Report rows of the ``n`` first clusters: metrics, peak hour, centre and time patterns.

    Every input row here is a time cell or a cluster, never a trip.
    """
    ranked = rank_clusters(cluster_metrics_from_cells(cells, cluster), by, n, cluster)
    described = ranked.join(cluster_patterns(cells, cluster), cluster).join(centers, cluster, "left")
    return described.orderBy("rank")


def cluster_distribution(stats: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Chart table: clusters by size, in millions of trips."""
    return stats.select(
        cluster, "trip_count", (F.col("trip_count") / 1_000_000).alias("trips_millions")
    ).orderBy(F.col("trip_count").desc(), cluster)


def fare_tiers(stats: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Chart table: mean fare per cluster with its tier, dearest first."""
    table = stats.select(cluster, "trip_count", "avg_fare", fare_tier("avg_fare").alias("tier"))
    return table.orderBy(*descending(table, "avg_fare", cluster))


def map_points(metrics: DataFrame, centers: DataFrame, n: int = 10, cluster: str = "cluster") -> DataFrame:
    """Map table: the ``n`` largest clusters that have a centre, with marker size and colour."""
    largest = rank_clusters(metrics, "count", n, cluster).join(centers, cluster).orderBy("rank")
    return largest.select(
        cluster,
        *POINT,
        "trip_count",
        "total_revenue",
        "avg_fare",
        marker_size("trip_count").alias("radius"),
        revenue_color("total_revenue").alias("color"),
    )


def bar_feed(
    ranked: DataFrame, metric: str = "total_revenue", cluster: str = "cluster", n: int = 10
) -> DataFrame:
    """Chart table: label and value of the first ``n`` ranked clusters; a missing metric is 0."""
    value = F.col(metric) if metric in ranked.columns else F.lit(None).cast("double")
    return ranked.filter(F.col("rank") <= n).select(
        "rank",
        F.concat(F.lit("Cluster "), F.col(cluster).cast("string")).alias("label"),
        F.coalesce(value, F.lit(0)).alias("value"),
    )
