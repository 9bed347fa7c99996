"""K-Means over trip coordinates with MLlib, and the measures of a clustering.

Trips take their coordinates from zones, so millions of rows share a point. The
fits here run on distinct points weighted by their row count: the same objective
over all rows, in a table whose size follows the number of points.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.functions.geo import Center, silhouette_band
from tripmarts.operators.clusters import POINT, assign_nearest
from tripmarts.operators.joins import attach_centroids, is_small
from tripmarts.operators.sampling import hash_sample, in_test_part
from tripmarts.runtime import cut_lineage
from tripmarts.schemas import (
    CLUSTERS,
    ELBOW_FRACTION,
    ELBOW_KS,
    LOCATION,
    MAX_ITER,
    SEED,
    TEST_FRACTION,
    TOLERANCE,
)

WEIGHT = "point_rows"
# Distinct points that the pairwise silhouette takes at most.
PAIRED_POINTS = 10_000


def distinct_points(df: DataFrame, columns: Sequence[str] = POINT, *, by: Sequence[str] = ()) -> DataFrame:
    """Each distinct point without NULLs and its row count; counted before the shuffle.

    Rows that are weighted points already have their weights added up.
    """
    rows = F.sum(WEIGHT) if WEIGHT in df.columns else F.count("*").cast("double")
    return df.na.drop(subset=list(columns)).groupBy(*by, *columns).agg(rows.alias(WEIGHT))


def zone_points(trips: DataFrame, centroids: DataFrame, location: str = LOCATION) -> DataFrame:
    """``distinct_points`` of trips whose coordinates are their zone's.

    Counts per location first, so the join sees one row per location. Time cells
    serve as well as trips: each stands for ``trips`` rows.
    """
    rows = F.sum("trips") if "trips" in trips.columns else F.count("*")
    counts = trips.groupBy(location).agg(rows.cast("double").alias(WEIGHT))
    return distinct_points(attach_centroids(counts, centroids, location))


def with_vector(df: DataFrame, columns: Sequence[str], invalid: str = "error") -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid=invalid
    ).transform(df)


def fit(
    df: DataFrame,
    k: int = CLUSTERS,
    columns: Sequence[str] = POINT,
    *,
    weight: str | None = None,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    tolerance: float = TOLERANCE,
    prediction: str = "cluster",
    start: str = "k-means||",
) -> KMeansModel:
    """Fit on the given rows; ``weight`` names the row count of collapsed points, ``start`` MLlib's way to begin."""
    estimator = KMeans(
        k=k,
        seed=seed,
        maxIter=max_iter,
        tol=tolerance,
        featuresCol="features",
        predictionCol=prediction,
        initMode=start,
    )
    if weight:
        estimator = estimator.setWeightCol(weight)
    names = [*columns, weight] if weight else list(columns)
    return estimator.fit(with_vector(df.select(*names), columns))


def in_fixed_order(points: DataFrame, columns: Sequence[str] = POINT) -> DataFrame:
    """Points measured to be few in one sorted part, so that a fit does not depend on partitions; others as they are."""
    return points.repartition(1).sortWithinPartitions(*columns) if is_small(points) else points


def _start(points: int, k: int) -> str:
    """With no more points than centres every point is a centre; oversampling might miss some."""
    return "random" if points <= k else "k-means||"


def fit_all_rows(
    df: DataFrame, k: int = CLUSTERS, columns: Sequence[str] = POINT, **options
) -> KMeansModel:
    """Fit that counts every row: one pass over the rows, then iterations over distinct points.

    Takes rows or weighted points, as do ``elbow`` and ``silhouette``.
    """
    points = in_fixed_order(cut_lineage(distinct_points(df, columns)), columns)
    start = _start(points.limit(k + 1).count(), k)
    return fit(points, k, columns, weight=WEIGHT, start=start, **options)


def centers_of(model: KMeansModel) -> list[Center]:
    """(cluster, coordinates) of every centre of a model."""
    return [(i, [float(x) for x in center]) for i, center in enumerate(model.clusterCenters())]


def centers_table(
    spark: SparkSession, centers: Iterable[Center], columns: Sequence[str] = POINT
) -> DataFrame:
    """A model's centres as a table (cluster, one column per coordinate)."""
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType())]
        + [T.StructField(name, T.DoubleType()) for name in columns]
    )
    rows = [(int(cluster), *map(float, point)) for cluster, point in centers]
    return spark.createDataFrame(rows, schema)


def assign(model: KMeansModel, df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """The rows with their cluster; needs the ``features`` vector the model was fitted on."""
    return model.transform(df).withColumnRenamed(model.getPredictionCol(), cluster)


def save_model(model: KMeansModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> KMeansModel:
    """A saved model. It has no training summary: keep its cost in a report."""
    return KMeansModel.load(path)


def elbow(
    df: DataFrame,
    ks: Sequence[int] = ELBOW_KS,
    columns: Sequence[str] = POINT,
    *,
    keys: Sequence[str] = (),
    fraction: float | None = None,
    selected: int | None = CLUSTERS,
    **options,
) -> DataFrame:
    """Cost per k: (k, effective_k, wssse, is_selected).

    Uses all rows, or the fraction chosen by ``keys``. MLlib returns fewer centres
    than asked for when there are fewer distinct points; ``effective_k`` says how many.
    """
    if fraction is not None:
        if not keys:
            raise ValueError("a sample needs key columns")
        df = hash_sample(df, keys, fraction)
    points = in_fixed_order(cut_lineage(distinct_points(df, columns)), columns)
    few, rows = points.limit(max(ks, default=0) + 1).count(), []
    for k in ks:
        model = fit(points, k, columns, weight=WEIGHT, start=_start(few, k), **options)
        cost = float(model.summary.trainingCost)
        rows.append((k, len(model.clusterCenters()), cost, k == selected))
    return df.sparkSession.createDataFrame(
        rows, "k INT, effective_k INT, wssse DOUBLE, is_selected BOOLEAN"
    )


def sampled_elbow(df: DataFrame, keys: Sequence[str], ks: Sequence[int] = ELBOW_KS, **options) -> DataFrame:
    """``elbow`` over the usual 10 % sample."""
    return elbow(df, ks, keys=keys, fraction=ELBOW_FRACTION, **options)


def wssse(assigned: DataFrame) -> DataFrame:
    """One row: rows with a centre, and their summed squared distance."""
    rows = F.col(WEIGHT) if WEIGHT in assigned.columns else F.lit(1.0)
    return assigned.filter(F.col("distance").isNotNull()).agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("n_rows"),
        F.sum(F.col("distance") * rows).alias("wssse"),
    )


def silhouette(
    assigned: DataFrame,
    columns: Sequence[str] = POINT,
    *,
    cluster: str = "cluster",
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean silhouette of all rows under squared Euclidean distance, and its band.

    A point's mean squared distance to a cluster follows from the cluster's row
    count, coordinate sums and sum of squared norms, so no pairs are formed. The
    rows collapse to distinct points first, and the sums come to each point in one
    array with an entry per cluster. ``by`` gives one result per value of a column
    with few values (such as train and test).
    """
    points = distinct_points(assigned.filter(F.col(cluster).isNotNull()), columns, by=[*by, cluster])
    w = F.col(WEIGHT)
    norm = _dot([F.col(c) for c in columns], [F.col(c) for c in columns])
    sums = points.groupBy(*by, cluster).agg(
        F.sum(w).alias("n"),
        F.sum(w * norm).alias("sq"),
        *[F.sum(w * F.col(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    profile = F.struct(F.col(cluster).alias("id"), "n", "sq", *[f"s{i}" for i in range(len(columns))])
    if by:
        groups = sums.groupBy(*by).agg(F.collect_list(profile).alias("_clusters"))
        points = points.join(F.broadcast(groups) if is_small(groups) else groups, list(by))
    else:
        groups = sums.agg(F.collect_list(profile).alias("_clusters"))
        points = points.withColumn("_clusters", groups.scalar())

    def mean_distance(c: Column) -> Column:
        dot = _dot([F.col(name) for name in columns], [c[f"s{i}"] for i in range(len(columns))])
        return norm + c["sq"] / c["n"] - 2 * dot / c["n"]

    return _mean_silhouette(points, mean_distance, cluster, by)


def euclidean_silhouette(
    assigned: DataFrame, columns: Sequence[str] = POINT, *, cluster: str = "cluster", max_points: int = PAIRED_POINTS
) -> DataFrame:
    """Mean silhouette of all rows under plain Euclidean distance, and its band.

    Roots do not add up from sums, so every distinct point meets every other: rows collapse to
    weighted points first, and more than ``max_points`` of them are an error, not a sample. Take
    ``sampling.fixed_sample`` of the rows before, or ``silhouette``. Without rows the result is NULL.
    """
    points = cut_lineage(distinct_points(assigned.filter(F.col(cluster).isNotNull()), columns, by=[cluster]))
    if points.limit(max_points + 1).count() > max_points:
        raise ValueError(f"more than {max_points} distinct points: measure a sample or squared distances")
    groups = points.groupBy(cluster).agg(
        F.sum(WEIGHT).alias("n"), F.collect_list(F.struct(*columns, WEIGHT)).alias("points")
    )
    profile = F.struct(F.col(cluster).alias("id"), "n", "points")
    spread = points.repartition(F.col(columns[0])).withColumn("_clusters", groups.agg(F.collect_list(profile)).scalar())

    def mean_distance(c: Column) -> Column:
        def added(total: Column, point: Column) -> Column:
            steps = [point[name] - F.col(name) for name in columns]
            return total + point[WEIGHT] * F.sqrt(_dot(steps, steps))

        return F.aggregate(c["points"], F.lit(0.0), added) / c["n"]

    return _mean_silhouette(spread, mean_distance, cluster, ())


def _mean_silhouette(
    points: DataFrame, mean_distance: Callable[[Column], Column], cluster: str, by: Sequence[str]
) -> DataFrame:
    """Mean over weighted points that hold all clusters in ``_clusters``; a point counts itself out of its own."""
    w = F.col(WEIGHT)
    own = F.filter("_clusters", lambda c: c["id"] == F.col(cluster))
    others = F.filter("_clusters", lambda c: c["id"] != F.col(cluster))
    scored = points.select(
        *by,
        w.alias("_w"),
        F.get(F.transform(own, lambda c: c["n"]), F.lit(0)).alias("_n"),
        F.get(F.transform(own, mean_distance), F.lit(0)).alias("_mean"),
        F.array_min(F.transform(others, mean_distance)).alias("_b"),
    ).withColumn("_a", F.try_divide(F.col("_mean") * F.col("_n"), F.col("_n") - 1))
    a, b = F.col("_a"), F.col("_b")
    value = (
        F.when(F.col("_n") <= 1, 0.0)
        .when(a < b, 1 - F.try_divide(a, b))
        .when(a > b, F.try_divide(b, a) - 1)
        .otherwise(0.0)
    )
    result = scored.groupBy(*by).agg(
        F.sum("_w").cast("bigint").alias("n_rows"),
        (F.sum(value * F.col("_w")) / F.sum("_w")).alias("silhouette"),
    )
    return result.withColumn("band", silhouette_band("silhouette"))


def _dot(left: Sequence[Column], right: Sequence[Column]) -> Column:
    terms = [x * y for x, y in zip(left, right, strict=True)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def validate(
    df: DataFrame,
    keys: Sequence[str],
    k: int = CLUSTERS,
    columns: Sequence[str] = POINT,
    *,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    **options,
) -> tuple[DataFrame, KMeansModel]:
    """Fit on a train part and measure both parts: (one-row report, model).

    Without a train or a test part the comparison and its labels are NULL; ``k`` is the number of
    centres the fit really has. Rows are parted by key and collapsed to weighted points in the same single
    pass; everything after works on points.
    """
    parted = df.withColumn("_test", in_test_part(keys, fraction, seed))
    points = cut_lineage(distinct_points(parted, columns, by=["_test"]))
    model = fit(points.filter(~F.col("_test")), k, columns, weight=WEIGHT, seed=seed, **options)
    assigned = assign_nearest(points, centers_of(model), columns)
    scores = silhouette(assigned, columns, by=["_test"])
    costs = assigned.groupBy("_test").agg(
        F.sum(F.col("distance") * F.col(WEIGHT)).alias("wssse")
    )
    both = scores.join(costs, "_test")

    def part(name: str, test: bool) -> Column:
        return F.max(F.when(F.col("_test") == test, F.col(name)))

    report = both.agg(
        F.coalesce(part("n_rows", False), F.lit(0)).alias("train_size"),
        F.coalesce(part("n_rows", True), F.lit(0)).alias("test_size"),
        part("wssse", False).alias("train_wssse"),
        part("wssse", True).alias("test_wssse"),
        part("silhouette", False).alias("train_silhouette"),
        part("silhouette", True).alias("test_silhouette"),
    )
    difference = F.abs(F.col("train_silhouette") - F.col("test_silhouette"))
    report = report.withColumns({
        "train_fraction": F.lit(1 - fraction),
        "test_fraction": F.lit(fraction),
        "k": F.lit(len(model.clusterCenters())),
        "silhouette_difference": difference,
        "generalization": F.when(difference < 0.05, "good").when(difference >= 0.05, "overfitting"),
        "overfitting_band": F.when(difference < 0.05, "none")
        .when(difference < 0.1, "minor")
        .when(difference >= 0.1, "significant"),
    })
    return report, model


def scale_sweep(
    df: DataFrame,
    sizes: Sequence[int],
    column: str,
    k: int = 10,
    *,
    collapse: bool = False,
    seed: int = SEED,
) -> DataFrame:
    """Timed one-column fits on samples of about the given sizes.

    Sizes above the row count are left out; a failed fit becomes a row with its error.
    """
    total = df.count()
    rows = []
    for size in [s for s in sizes if s <= total]:
        sample = df.select(column).sample(fraction=size / total, seed=seed)
        start = time.perf_counter()
        try:
            if collapse:
                model = fit_all_rows(sample, k, [column], seed=seed)
            else:
                model = fit(sample, k, [column], seed=seed)
            cost = float(model.summary.trainingCost)
        except Exception as error:  # the sweep reports failures as rows
            rows.append((size, k, None, None, None, "error", str(error)))
            continue
        seconds = time.perf_counter() - start
        rows.append((size, k, seconds, size / seconds, cost, "success", None))
    return df.sparkSession.createDataFrame(
        rows,
        "n_samples BIGINT, k INT, time_seconds DOUBLE, throughput DOUBLE, wssse DOUBLE, "
        "status STRING, error STRING",
    )
