from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmarts.functions.features import weekday_name
from tripmarts.operators import features


def at(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    return df.select(F.col("t").cast("timestamp_ntz").alias("tpep_pickup_datetime"))


@pytest.mark.parametrize(
    ("text", "weekend", "rush"),
    [
        ("2019-03-02 08:00:00", 1, 0),
        ("2019-03-03 08:00:00", 1, 0),
        ("2019-03-04 06:59:59", 0, 0),
        ("2019-03-04 07:00:00", 0, 1),
        ("2019-03-04 09:59:59", 0, 1),
        ("2019-03-04 10:00:00", 0, 0),
        ("2019-03-08 16:59:59", 0, 0),
        ("2019-03-08 17:00:00", 0, 1),
        ("2019-03-08 19:59:59", 0, 1),
        ("2019-03-08 20:00:00", 0, 0),
        (None, 0, 0),
    ],
)
def test_flags(spark, text, weekend, rush):
    row = features.add_time_features(at(spark, text)).first()
    assert (row.is_weekend, row.is_rush_hour) == (weekend, rush)


def test_calendar(spark):
    row = features.add_time_features(at(spark, "2019-03-03 08:15:00")).first()
    assert (row.pickup_hour, row.pickup_dayofweek, row.pickup_month, row.pickup_year) == (8, 1, 3, 2019)


def test_duration_in_whole_seconds(spark):
    df = at(spark, "2019-03-03 08:00:00.9").withColumn(
        "tpep_dropoff_datetime", F.lit("2019-03-03 08:01:00.1").cast("timestamp_ntz")
    )
    assert features.add_time_features(df).first().trip_duration_minutes == 1.0
    assert "trip_duration_minutes" not in features.add_time_features(df.drop("tpep_dropoff_datetime")).columns


def test_revenue(spark):
    df = spark.createDataFrame(
        [(10.0, 2.0, 4.0), (10.0, None, 4.0), (10.0, 2.0, 0.0), (10.0, 2.0, -1.0)],
        "fare_amount DOUBLE, tip_amount DOUBLE, trip_duration_minutes DOUBLE",
    )
    rows = features.add_revenue(df).select("total_revenue", "revenue_per_minute").collect()
    assert [tuple(r) for r in rows] == [(12.0, 3.0), (None, None), (12.0, 0.0), (12.0, 0.0)]
    assert features.add_revenue(df.drop("tip_amount")).first().total_revenue == 10.0
    assert features.add_revenue(df.drop("fare_amount")).columns == ["tip_amount", "trip_duration_minutes"]


@pytest.mark.parametrize(
    ("values", "flags"),
    [
        ([1.0, 2.0, 3.0, 4.0], [0, 0, 1, 1]),
        ([5.0, 5.0, 5.0, 1.0], [1, 1, 1, 0]),
        ([0.0, 0.0, 0.0, -1.0], [1, 1, 1, 0]),
        ([None, None], [0, 0]),
        ([], []),
    ],
)
def test_high_value(spark, values, flags):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, total_revenue DOUBLE")
    rows = features.add_high_value_flag(df).orderBy("i").collect()
    assert [r.is_high_value for r in rows] == flags


def test_vectors(spark):
    df = spark.createDataFrame(
        [(40.5, -74.0), (0.0, -74.0), (None, -74.0), (40.6, None)],
        "pickup_latitude DOUBLE, pickup_longitude DOUBLE",
    )
    located = features.add_location_vector(df)
    assert [list(r.location_vector) for r in located.collect()] == [[40.5, -74.0]]
    other = df.drop("pickup_latitude")
    assert features.add_location_vector(other) is other
    assert features.vector_rows(located, "location_vector").columns == ["features"]
    with pytest.raises(ValueError):
        features.vector_rows(df, "location_vector")
    with pytest.raises(ValueError):
        features.add_feature_vector(df, ["nothing"])
    skipped = features.add_feature_vector(df, ["pickup_latitude", "nothing"], invalid="skip")
    assert skipped.count() == 3
    assert features.drop_incomplete(df, ["pickup_latitude", "pickup_longitude"]).count() == 2


def test_weekday_names(spark):
    df = spark.createDataFrame([(1,), (7,), (8,), (None,)], "d INT")
    assert [r[0] for r in df.select(weekday_name("d")).collect()] == ["Sun", "Sat", "8", None]
