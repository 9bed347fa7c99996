"""The jobs end to end, from raw files to reports."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tripmarts.plans import jobs
from tripmarts.sources import messages, star, tables
from tripmarts.streaming import sinks

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    trips = star.event_trips(spark, FOLDER)
    trips.unionByName(trips.filter("tip_amount > 0")).write.parquet(str(folder / "raw"))
    zones = star.nation_zones(spark, FOLDER)
    tables.write_table(zones.coalesce(1), str(folder / "zones"), fmt="csv")
    tables.write_table(star.nation_centroids(spark, FOLDER).coalesce(1), str(folder / "points"), fmt="csv")
    return folder


def report(root, name):
    (part,) = (root / "reports" / name).glob("part-*.json")
    return [json.loads(line) for line in part.read_text().splitlines()]


@pytest.fixture(scope="module")
def done(spark, root):
    path = {n: str(root / n) for n in ("raw", "clean", "featured", "zones", "points", "marts", "model", "reports")}
    jobs.clean(spark, path["raw"], path["clean"], path["reports"])
    jobs.features(spark, path["clean"], path["featured"], path["zones"])
    jobs.hotspots(spark, path["featured"], path["marts"], path["reports"])
    cells = f"{path['marts']}/time_cells"
    jobs.cluster(spark, cells, path["points"], path["model"], path["reports"], k=4, ks=(2, 4, 6))
    jobs.validate_clusters(spark, path["featured"], path["points"], path["reports"], ["trip_id"], 4)
    jobs.assign_clusters(spark, path["featured"], path["points"], path["model"], str(root / "clustered"))
    jobs.cluster_hotspots(spark, cells, path["points"], path["model"], path["reports"])
    jobs.sample_trips(spark, path["clean"], str(root / "sample"), 0.1, ["trip_id"])
    return path


def test_cleaning(spark, root, done):
    (summary,) = report(root, "cleaning_summary")
    assert summary["cleaned_row_count"] == spark.read.parquet(done["clean"]).count()
    steps = report(root, "cleaning_steps")
    assert sum(s["rows_removed"] for s in steps) == summary["rows_removed"]
    assert steps[-1]["rule"] == "duplicates" and steps[-1]["rows_removed"] > 0
    assert len(report(root, "data_quality")) == 8


def test_features(spark, done):
    df = spark.read.parquet(done["featured"])
    assert {"pickup_hour", "is_high_value", "revenue_per_minute", "Zone"} <= set(df.columns)
    assert df.count() == spark.read.parquet(done["clean"]).count()


def test_hotspots(spark, root, done):
    df = spark.read.parquet(done["featured"])
    top = report(root, "top_by_trips")
    assert top[0]["rank"] == 1
    assert top[0]["trip_count"] == df.groupBy("PULocationID").count().agg(F.max("count")).first()[0]
    assert len(report(root, "temporal_patterns")) == 5


def test_clusters(spark, root, done):
    df = spark.read.parquet(done["featured"])
    clustered = spark.read.parquet(str(root / "clustered"))
    assert clustered.columns == [
        "PULocationID", "latitude", "longitude", "cluster", "fare_amount", "total_revenue"
    ]
    located = df.filter("PULocationID < 25").count()
    assert clustered.count() == located
    stats = {s["cluster"]: s["trip_count"] for s in report(root, "cluster_statistics")}
    assert stats == {r.cluster: r["count"] for r in clustered.groupBy("cluster").count().collect()}
    (cost,), (silhouette,) = report(root, "cost"), report(root, "silhouette")
    assert cost["n_rows"] == silhouette["n_rows"] == located
    elbow = {e["k"]: e for e in report(root, "elbow")}
    assert elbow[2]["wssse"] > elbow[6]["wssse"]
    assert cost["wssse"] == pytest.approx(elbow[4]["wssse"])
    (validation,) = report(root, "validation")
    assert validation["train_size"] + validation["test_size"] == located
    hotspots = report(root, "cluster_hotspots_by_count")
    assert [h["trip_count"] for h in hotspots] == sorted(stats.values(), reverse=True)
    assert sum(hotspots[0]["hourly"].values()) == hotspots[0]["trip_count"]


def test_sample(spark, root, done):
    assert 0 < spark.read.parquet(str(root / "sample")).count() < spark.read.parquet(done["clean"]).count()


@pytest.mark.parametrize("with_model", [True, False])
def test_live(spark, root, done, tmp_path, with_model):
    messages.to_messages(star.event_trips(spark, FOLDER)).write.parquet(str(tmp_path / "in"))
    query = jobs.live_console(
        spark,
        {},
        done["points"],
        str(tmp_path / "checkpoint"),
        done["model"] if with_model else str(tmp_path / "no_model"),
        source="parquet",
        path=str(tmp_path / "in"),
        trigger=sinks.DONE,
    )
    query.awaitTermination()
    assert "Console" in query.lastProgress["sink"]["description"]
    assert query.lastProgress["sink"]["numOutputRows"] == (4 if with_model else 10)
