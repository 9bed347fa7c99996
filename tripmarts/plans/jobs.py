"""The batch and streaming jobs. Each reads tables, writes tables, and hands on through them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmarts.operators import clusters, kmeans, locations, profile
from tripmarts.operators.cleaning import clean_trips, cleaning_report, cleaning_summary
from tripmarts.operators.features import add_location_vector, add_trip_features
from tripmarts.operators.joins import attach_centroids, join_zones
from tripmarts.operators.sampling import hash_sample, random_sample
from tripmarts.runtime import cut_lineage
from tripmarts.schemas import CLUSTERS, ELBOW_KS, LOCATION, SEED
from tripmarts.sources import tables
from tripmarts.streaming import sinks, trips as live


def sample_trips(
    spark: SparkSession,
    source: str,
    target: str,
    fraction: float = 0.01,
    keys: Sequence[str] = (),
    seed: int = SEED,
) -> None:
    """Write a seeded sample of one trip table; reproducible by key if keys are given."""
    df = tables.read_table(spark, source)
    sample = hash_sample(df, keys, fraction, seed) if keys else random_sample(df, fraction, seed)
    tables.write_table(sample, target)


def clean(
    spark: SparkSession,
    raw: str,
    target: str,
    reports: str,
    pattern: str = "*.parquet",
    rare_duplicates: bool = False,
    **options,
) -> None:
    """Profile the raw trips, clean them, and report what was removed.

    ``rare_duplicates`` leaves rows where they are if few have copies; see ``drop_rare_duplicates``.
    """
    df = tables.read_trips(spark, raw, pattern)
    tables.write_report(profile.dataset_info(df), f"{reports}/dataset_info")
    tables.write_report(profile.quality_profile(df), f"{reports}/data_quality")
    tables.write_table(clean_trips(df, rare_duplicates=rare_duplicates, **options), target)
    cleaned = tables.read_table(spark, target)
    tables.write_sample(cleaned, f"{reports}/cleaned_data_sample")
    steps = cut_lineage(cleaning_report(df, cleaned=cleaned, **options))
    tables.write_report(steps, f"{reports}/cleaning_steps")
    tables.write_report(cleaning_summary(steps), f"{reports}/cleaning_summary")


def features(
    spark: SparkSession,
    cleaned: str,
    target: str,
    zones: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Add time, revenue and zone columns. ``target`` must lie outside ``cleaned``."""
    df = add_trip_features(tables.read_table(spark, cleaned))
    if zones is not None:
        df = join_zones(df, tables.read_zones(spark, zones))
    tables.write_table(add_location_vector(df), target, partition_by=partition_by)


def hotspots(spark: SparkSession, featured: str, target: str, reports: str, n: int = 20) -> None:
    """Time cells, location statistics, rankings and patterns from one scan of the trips."""
    df = tables.read_table(spark, featured)
    tables.write_table(locations.time_cells(df), f"{target}/time_cells")
    cells = tables.read_table(spark, f"{target}/time_cells")
    tables.write_table(locations.location_stats_from_cells(cells), f"{target}/location_statistics")
    stats = tables.read_table(spark, f"{target}/location_statistics")
    for by in locations.METRICS:
        tables.write_report(locations.top_locations(stats, by, n), f"{reports}/top_by_{by}")
    busiest = locations.top_locations(stats, "trips", 5)
    # Five ids: the limit bounds what is broadcast.
    top_cells = cells.join(F.broadcast(busiest.select(LOCATION)), LOCATION, "left_semi")
    tables.write_report(
        clusters.cluster_patterns(top_cells, LOCATION), f"{reports}/temporal_patterns"
    )


def cluster(
    spark: SparkSession,
    cells_path: str,
    centroids: str,
    model_path: str,
    reports: str,
    k: int = CLUSTERS,
    ks: Sequence[int] = ELBOW_KS,
) -> KMeansModel:
    """Elbow table, model over all trips, its quality and its cluster statistics.

    Works on the time cells: every trip counts, and no trip is read again.
    """
    cells = tables.read_table(spark, cells_path)
    zones = tables.read_centroids(spark, centroids)
    points = kmeans.zone_points(cells, zones)
    tables.write_report(kmeans.elbow(points, ks, selected=k), f"{reports}/elbow")
    model = kmeans.fit_all_rows(points, k)
    kmeans.save_model(model, model_path)
    centers = kmeans.centers_of(model)
    assigned = clusters.assign_nearest(points, centers)
    tables.write_report(kmeans.wssse(assigned), f"{reports}/cost")
    tables.write_report(kmeans.silhouette(assigned), f"{reports}/silhouette")
    located = clusters.attach_clusters(cells, clusters.zone_clusters(zones, centers))
    stats = clusters.cluster_stats_from_cells(located)
    tables.write_report(stats, f"{reports}/cluster_statistics")
    tables.write_centers(kmeans.centers_table(spark, centers), f"{reports}/cluster_centers")
    return model


def validate_clusters(
    spark: SparkSession,
    featured: str,
    centroids: str,
    reports: str,
    keys: Sequence[str],
    k: int = CLUSTERS,
) -> None:
    """Fit on a train part of the trips and report both parts."""
    df = tables.read_table(spark, featured)
    located = attach_centroids(df, tables.read_centroids(spark, centroids))
    report, _ = kmeans.validate(located, keys, k)
    tables.write_report(report, f"{reports}/validation")


def assign_clusters(
    spark: SparkSession, featured: str, centroids: str, model_path: str, target: str
) -> None:
    """Write the trips with their coordinates and the saved model's cluster."""
    centers = kmeans.centers_of(kmeans.load_model(model_path))
    zones = clusters.zone_clusters(tables.read_centroids(spark, centroids), centers)
    df = clusters.attach_clusters(tables.read_table(spark, featured), zones)
    tables.write_table(tables.clustered_trips(df), target)


def cluster_hotspots(
    spark: SparkSession, cells_path: str, centroids: str, model_path: str, reports: str
) -> None:
    """Ranked clusters with peak hours, centres and patterns, for a saved model."""
    centers = kmeans.centers_of(kmeans.load_model(model_path))
    zones = clusters.zone_clusters(tables.read_centroids(spark, centroids), centers)
    cells = clusters.attach_clusters(tables.read_table(spark, cells_path), zones)
    points = kmeans.centers_table(spark, centers)
    for by in clusters.RANKINGS:
        tables.write_report(
            clusters.hotspot_report(cells, points, by), f"{reports}/cluster_hotspots_by_{by}"
        )


def live_console(
    spark: SparkSession,
    options: dict[str, str],
    centroids: str,
    checkpoint: str,
    model_path: str | None = None,
    source: str = "kafka",
    path: str | None = None,
    trigger: dict = sinks.EVERY_5_SECONDS,
) -> StreamingQuery:
    """Print running counts of live trips: per cluster with a model, else per location."""
    model = None
    if model_path is not None and tables.path_exists(spark, model_path):
        model = kmeans.load_model(model_path)
    messages = live.message_stream(spark, source, path, options)
    points = tables.read_centroids(spark, centroids)
    return sinks.to_console(live.live_counts(messages, points, model), checkpoint, trigger)
