from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tripmarts.operators import kmeans, locations
from tripmarts.schemas import TRIP_SCHEMA
from tripmarts.sources import messages, star
from tripmarts.streaming import sinks
from tripmarts.streaming import trips as live

FOLDER = "/root/testdata/sf0.001"
CENTERS = [(0, (40.5, -74.2)), (1, (40.65, -74.0))]


@pytest.fixture(scope="module")
def centroids(spark):
    return star.nation_centroids(spark, FOLDER)


@pytest.fixture(scope="module")
def trips(spark):
    return star.event_trips(spark, FOLDER)


@pytest.fixture(scope="module")
def inbox(spark, trips, tmp_path_factory):
    """Five message files, and one with messages that cannot be used."""
    path = str(tmp_path_factory.mktemp("inbox"))
    messages.to_messages(trips).repartition(5).write.mode("append").parquet(path)
    bad = [("not json",), ("",), (None,), (json.dumps({"PULocationID": "x", "fare_amount": 5.0}),)]
    spark.createDataFrame(bad, "value STRING").coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, inbox):
    return live.message_stream(spark, "parquet", inbox, {"maxFilesPerTrigger": "1"})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_malformed_messages(spark):
    df = spark.createDataFrame(
        [("not json",), (json.dumps({"VendorID": "x", "fare_amount": 5.5, "PULocationID": 3}),)], "value STRING"
    )
    first, second = live.parse_messages(df).collect()
    assert all(v is None for v in first)
    assert (second.VendorID, second.fare_amount, second.PULocationID) == (None, 5.5, 3)
    assert len(first) == len(TRIP_SCHEMA.strip().split("\n")) == 19


def test_counts_match_the_batch(spark, inbox, trips, tmp_path):
    counts = live.live_counts(stream(spark, inbox))
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    sinks.to_snapshots(counts, path, checkpoint, sinks.DONE).awaitTermination()
    batches = spark.read.parquet(path).select("batch").distinct().count()
    assert 6 <= batches <= sinks.SLOTS
    batch = live.running_top_locations(live.parse_messages(spark.read.parquet(inbox)))
    latest = sinks.latest_snapshot(spark, path)
    assert rows(latest.na.fill(-1)) == rows(batch.na.fill(-1))


def test_model_counts_match_the_batch(spark, inbox, trips, centroids, tmp_path):
    model = kmeans.fit_all_rows(kmeans.zone_points(trips, centroids), 3)
    counts = live.live_counts(stream(spark, inbox), centroids, model)
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    sinks.to_snapshots(counts, path, checkpoint, sinks.DONE).awaitTermination()
    scored = live.score_with_centers(trips, centroids, kmeans.centers_of(model))
    expected = live.running_cluster_counts(scored)
    assert rows(sinks.latest_snapshot(spark, path)) == rows(expected)


def test_restart_continues(spark, trips, tmp_path):
    inbox, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    values = messages.to_messages(trips)
    half = F.col("value").contains('"tip_amount":0.0')
    values.filter(half).write.parquet(inbox)

    def run():
        counts = live.live_counts(live.message_stream(spark, "parquet", inbox))
        sinks.to_snapshots(counts, path, checkpoint, sinks.DONE).awaitTermination()
        return sinks.latest_snapshot(spark, path).agg(F.sum("trip_count")).first()[0]

    first = run()
    values.filter(~half).write.mode("append").parquet(inbox)
    assert first < run()
    expected = trips.groupBy("PULocationID").count().orderBy(F.desc("count"), "PULocationID").limit(10)
    assert rows(sinks.latest_snapshot(spark, path)) == rows(expected)


def test_append_table(spark, inbox, centroids, trips, tmp_path):
    schema = "trip_id BIGINT, PULocationID BIGINT, fare_amount DOUBLE"
    parsed = live.parse_messages(stream(spark, inbox), schema)
    scored = live.score_with_centers(parsed, centroids, CENTERS).select("trip_id", "cluster")
    path = str(tmp_path / "out")
    sinks.to_table(scored, path, str(tmp_path / "checkpoint"), sinks.DONE).awaitTermination()
    expected = live.score_with_centers(trips, centroids, CENTERS).select("trip_id", "cluster")
    assert rows(spark.read.parquet(path)) == rows(expected)


def test_console(spark, inbox, tmp_path):
    counts = live.live_counts(stream(spark, inbox))
    query = sinks.to_console(counts, str(tmp_path / "checkpoint"), sinks.DONE)
    query.awaitTermination()
    assert "Console" in query.lastProgress["sink"]["description"]
    assert query.lastProgress["sink"]["numOutputRows"] == 10


def test_topic_options(spark):
    """The topic reader is only configured here: its connector is not installed."""
    assert live.TOPIC_OPTIONS == {"startingOffsets": "latest", "failOnDataLoss": "false"}
    with pytest.raises(Exception, match="kafka"):
        live.message_stream(spark, options={"subscribe": "trips", "kafka.bootstrap.servers": "none:1"})


def test_live_trips_feed_the_batch_operators(spark, inbox):
    parsed = live.parse_messages(spark.read.parquet(inbox))
    assert locations.top_locations(
        parsed.groupBy("PULocationID").agg(F.count("*").alias("trip_count")), "trips", 3
    ).count() == 3


def test_snapshot_before_the_first_batch(spark, tmp_path):
    schema = spark.range(0).schema
    assert sinks.latest_snapshot(spark, str(tmp_path / "none"), schema).count() == 0
