from __future__ import annotations

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator

from tripmarts.operators import clusters, kmeans, sampling

POINTS = "trip_id BIGINT, latitude DOUBLE, longitude DOUBLE"


@pytest.fixture(scope="module")
def trips(spark):
    """Twelve distinct points of very different weight; a third of the rows share one."""
    df = spark.range(0, 3000, 1, 4).selectExpr(
        "id AS trip_id",
        "IF(id % 3 = 0, 0, CAST(id % 12 AS INT)) AS p",
    )
    return df.selectExpr(
        "trip_id", "40 + (p % 4) * 0.1 AS latitude", "-74 + p * p * 0.01 AS longitude"
    ).cache()


def test_points_keep_every_row(trips):
    points = kmeans.distinct_points(trips)
    assert points.agg({kmeans.WEIGHT: "sum"}).first()[0] == 3000
    assert kmeans.distinct_points(points).exceptAll(points).count() == 0


def test_zone_points(spark, trips):
    placed = trips.selectExpr("trip_id", "trip_id % 7 AS PULocationID")
    zones = spark.createDataFrame(
        [(0, 1.0, 1.0), (1, 1.0, 1.0), (2, 2.0, 2.0)], "LocationID INT, latitude DOUBLE, longitude DOUBLE"
    )
    rows = {r.latitude: r[kmeans.WEIGHT] for r in kmeans.zone_points(placed, zones).collect()}
    assert rows == {1.0: 858.0, 2.0: 429.0}


def test_cost_is_the_cost_of_all_rows(trips):
    """The weighted fit's own cost equals the cost of its centres over every row."""
    model = kmeans.fit_all_rows(trips, 4)
    centers = kmeans.centers_of(model)
    cost = kmeans.wssse(clusters.assign_nearest(trips, centers)).first()
    assert cost.n_rows == 3000
    assert cost.wssse == pytest.approx(model.summary.trainingCost, rel=1e-6)
    points = kmeans.distinct_points(trips)
    assert kmeans.wssse(clusters.assign_nearest(points, centers)).first().wssse == pytest.approx(cost.wssse)


def test_silhouette_equals_the_evaluator(trips):
    model = kmeans.fit_all_rows(trips, 4)
    rows = model.transform(kmeans.with_vector(trips, kmeans.POINT))
    expected = ClusteringEvaluator(predictionCol="cluster").evaluate(rows)
    ours = kmeans.silhouette(clusters.assign_nearest(trips, kmeans.centers_of(model))).first()
    assert ours.silhouette == pytest.approx(expected, abs=1e-9)
    assert ours.n_rows == 3000
    points = clusters.assign_nearest(kmeans.distinct_points(trips), kmeans.centers_of(model))
    assert kmeans.silhouette(points).first().silhouette == pytest.approx(expected, abs=1e-9)


def test_silhouette_of_single_row_clusters(spark):
    df = spark.createDataFrame(
        [(0, 0.0, 0.0), (1, 5.0, 0.0)], "cluster INT, latitude DOUBLE, longitude DOUBLE"
    )
    assert kmeans.silhouette(df).first().silhouette == 0.0


@pytest.mark.parametrize(("score", "band"), [(0.5, "good"), (0.51, "excellent"), (0.25, "weak"), (0.0, "poor"), (-1.0, "poor")])
def test_bands(spark, score, band):
    from tripmarts.functions.geo import silhouette_band

    df = spark.createDataFrame([(score,)], "s DOUBLE")
    assert df.select(silhouette_band("s")).first()[0] == band


def test_assignment_matches_the_model(trips):
    model = kmeans.fit_all_rows(trips, 4)
    scored = kmeans.assign(model, kmeans.with_vector(trips, kmeans.POINT))
    ours = clusters.assign_nearest(scored, kmeans.centers_of(model))
    assert ours.filter("cluster_id <> cluster").count() == 0


def test_elbow(trips):
    rows = kmeans.elbow(trips, (2, 6, 50), selected=6).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 6, 50]
    assert rows[0].wssse >= rows[1].wssse >= rows[2].wssse >= 0
    assert rows[2].effective_k <= 12
    assert [r.is_selected for r in rows] == [False, True, False]
    sampled = kmeans.sampled_elbow(trips, ["trip_id"], (2,)).first()
    assert sampled.wssse < rows[0].wssse
    with pytest.raises(ValueError):
        kmeans.elbow(trips, (2,), fraction=0.5)


def test_validation(trips):
    report, model = kmeans.validate(trips, ["trip_id"], 4)
    row = report.first()
    train, test = sampling.hash_split(trips, ["trip_id"])
    assert (row.train_size, row.test_size) == (train.count(), test.count())
    assert row.train_size + row.test_size == 3000
    assert row.train_wssse == pytest.approx(model.summary.trainingCost, rel=1e-6)
    centers = kmeans.centers_of(model)
    expected = kmeans.wssse(clusters.assign_nearest(test, centers)).first().wssse
    assert row.test_wssse == pytest.approx(expected)
    assert -1 <= row.test_silhouette <= 1
    assert row.silhouette_difference == pytest.approx(abs(row.train_silhouette - row.test_silhouette))
    assert row.generalization == ("good" if row.silhouette_difference < 0.05 else "overfitting")


def test_save_and_load(trips, tmp_path):
    model = kmeans.fit_all_rows(trips, 3)
    kmeans.save_model(model, str(tmp_path / "model"))
    kmeans.save_model(model, str(tmp_path / "model"))
    loaded = kmeans.load_model(str(tmp_path / "model"))
    assert kmeans.centers_of(loaded) == kmeans.centers_of(model)
    table = kmeans.centers_table(trips.sparkSession, kmeans.centers_of(loaded))
    assert table.columns == ["cluster", "latitude", "longitude"] and table.count() == 3


def test_sweep(trips):
    rows = kmeans.scale_sweep(trips, [100, 1000, 9999], "latitude", 3).collect()
    assert [r.n_samples for r in rows] == [100, 1000]
    assert all(r.status == "success" and r.throughput > 0 for r in rows)
    failed = kmeans.scale_sweep(trips, [100], "latitude", 1).first()
    assert failed.status == "error" and failed.error


def test_plain_silhouette_equals_all_pairs(spark):
    rows = [(float(n % 5), float(n * n % 7), n % 3) for n in range(60)] + [(50.0, 50.0, 9), (None, 1.0, 0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, cluster int")
    whole = [row for row in rows if None not in row]
    values = []
    for x, y, own in whole:
        far = {}
        for u, v, other in whole:
            far.setdefault(other, []).append(((x - u) ** 2 + (y - v) ** 2) ** 0.5)
        if len(far[own]) == 1:
            values.append(0.0)
            continue
        a = sum(far[own]) / (len(far[own]) - 1)
        b = min(sum(d) / len(d) for other, d in far.items() if other != own)
        values.append((b - a) / max(a, b))
    found = kmeans.euclidean_silhouette(df).first()
    assert found.n_rows == len(whole)
    assert found.silhouette == pytest.approx(sum(values) / len(values))
    assert kmeans.euclidean_silhouette(df.limit(0)).first().silhouette is None
    with pytest.raises(ValueError):
        kmeans.euclidean_silhouette(df, max_points=5)


def test_fit_does_not_depend_on_partitions(spark):
    rows = [(n * 37 % 101 / 7, n * 53 % 97 / 3) for n in range(400)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    fits = [kmeans.fit_all_rows(df.repartition(parts), 6) for parts in (1, 4, 7)]
    assert len({str(kmeans.centers_of(model)) for model in fits}) == 1
    few = df.limit(9)
    model = kmeans.fit_all_rows(few, 20)
    points = {tuple(row) for row in few.distinct().collect()}
    assert {tuple(point) for _, point in kmeans.centers_of(model)} == points
    assert model.summary.trainingCost == pytest.approx(0, abs=1e-9)
