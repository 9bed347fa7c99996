"""Parse, enrich, score and count a stream of JSON trip messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.functions.geo import Center
from tripmarts.operators.clusters import POINT, attach_clusters, zone_clusters
from tripmarts.operators.joins import attach_centroids
from tripmarts.operators.kmeans import with_vector
from tripmarts.schemas import LOCATION, TRIP_SCHEMA

# How a topic is read unless the caller says otherwise.
TOPIC_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def message_stream(
    spark: SparkSession,
    source: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stream with the messages in ``value``: a topic, or files that hold such a column.

    Pace it with the source's own options, ``maxOffsetsPerTrigger`` for a topic and
    ``maxFilesPerTrigger`` for files.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.options(**TOPIC_OPTIONS)
    else:
        reader = reader.schema("value STRING")
    reader = reader.options(**(options or {}))
    return reader.load(path) if path else reader.load()


def parse_messages(messages: DataFrame, schema: str = TRIP_SCHEMA) -> DataFrame:
    """The fields of each message. A malformed message is a row of NULLs, a field of the
    wrong type is NULL."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("trip"))
    return parsed.select("trip.*")


def score_with_model(trips: DataFrame, centroids: DataFrame, model: KMeansModel) -> DataFrame:
    """Coordinates and the model's cluster for trips from a known zone; others are left out."""
    return model.transform(with_vector(attach_centroids(trips, centroids), POINT, "skip"))


def score_with_centers(
    trips: DataFrame, centroids: DataFrame, centers: Sequence[Center], location: str = LOCATION
) -> DataFrame:
    """As ``score_with_model`` with the centres alone: each zone is scored once, not each trip."""
    return attach_clusters(trips, zone_clusters(centroids, centers), location)


def running_cluster_counts(scored: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Trips per cluster so far, most first; the state holds one row per cluster."""
    counts = scored.groupBy(cluster).agg(F.count("*").alias("trip_count"))
    return counts.orderBy(F.col("trip_count").desc(), cluster)


def running_top_locations(trips: DataFrame, n: int = 10, location: str = LOCATION) -> DataFrame:
    """The n locations with most trips so far; malformed messages count under NULL."""
    counts = trips.groupBy(location).agg(F.count("*").alias("trip_count"))
    return counts.orderBy(F.col("trip_count").desc(), F.col(location).asc_nulls_first()).limit(n)


def live_counts(
    messages: DataFrame, centroids: DataFrame | None = None, model: KMeansModel | None = None
) -> DataFrame:
    """Running counts per cluster with a model, else the running top locations."""
    trips = parse_messages(messages)
    if model is None or centroids is None:
        return running_top_locations(trips)
    return running_cluster_counts(
        score_with_model(trips, centroids, model), model.getPredictionCol()
    )
