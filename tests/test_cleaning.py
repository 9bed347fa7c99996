from __future__ import annotations

import pytest

from tripmarts.operators import cleaning
from tripmarts.schemas import Bounds

TRIPS = """trip_id INT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,
    passenger_count DOUBLE, trip_distance DOUBLE, fare_amount DOUBLE"""


def ids(df):
    return sorted(row[0] for row in df.select(df.columns[0]).collect())


def trips(spark, rows):
    names = [line.split()[0] for line in TRIPS.split(",")]
    types = [line.split()[1] for line in TRIPS.split(",")]
    text = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in row) for row in rows],
        ", ".join(f"{n} STRING" for n in names),
    )
    return text.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types, strict=True)])


def test_coordinates(spark):
    rows = [
        (1, 40.4, -74.3),
        (2, 40.9, -73.7),
        (3, 40.39, -74.0),
        (4, None, -74.0),
        (5, 40.5, None),
        (6, 0.0, -74.0),
        (7, 40.5, -73.69),
    ]
    df = spark.createDataFrame(rows, "id INT, pickup_latitude DOUBLE, pickup_longitude DOUBLE")
    assert ids(cleaning.filter_coordinates(df)) == [1, 2]
    around_zero = Bounds(-90, 90, -180, 180)
    assert ids(cleaning.filter_coordinates(df, bounds=around_zero)) == [1, 2, 3, 7]


def test_times(spark):
    start = "2019-03-01 10:00:00"
    ends = {
        1: "2019-03-01 10:00:00",
        2: "2019-03-02 10:00:00",
        3: "2019-03-02 10:00:01",
        4: "2019-03-02 10:00:00.9",
        5: None,
        6: "2019-03-01 09:59:59",
        7: "2019-03-01 10:00:00.000001",
    }
    df = trips(spark, [(i, start, end, 1, 1, 1) for i, end in ends.items()])
    assert ids(cleaning.filter_times(df)) == [2, 4, 7]
    assert ids(cleaning.filter_times(df, max_hours=1)) == [7]


def test_times_ignore_session_zone(spark):
    df = trips(spark, [(1, "2019-03-10 01:30:00", "2019-03-10 03:30:00", 1, 1, 1)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert ids(cleaning.filter_times(df, max_hours=1.5)) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_values(spark):
    at = ("2019-03-01 10:00:00", "2019-03-01 10:10:00")
    rows = [
        (1, *at, 0, 1, 10),
        (2, *at, -1, 1, 10),
        (3, *at, None, 1, 10),
        (4, *at, 1, 0, 10),
        (5, *at, 1, 0, 0),
        (6, *at, 1, -1, 10),
        (7, *at, 1, 1, 501),
        (8, *at, 1, None, 10),
        (9, *at, 1, 1, None),
        (10, *at, 1, 1, 500),
    ]
    df = trips(spark, rows)
    assert ids(cleaning.filter_values(df)) == [1, 4, 7, 10]
    assert ids(cleaning.filter_values(df, max_fare=500)) == [1, 4, 10]
    assert ids(cleaning.filter_values(df, min_passengers=1, min_distance=0.5)) == [7, 10]
    assert ids(cleaning.filter_values(df.drop("trip_distance"))) == [1, 4, 6, 8, 10]
    assert ids(cleaning.filter_values(df.drop("trip_distance"), max_fare=1000)) == [1, 4, 6, 7, 8, 10]
    assert ids(cleaning.filter_values(df.drop("fare_amount"))) == [1, 4, 5, 7, 9, 10]
    assert ids(cleaning.filter_values(df.select("trip_id"))) == list(range(1, 11))


def test_duplicates(spark):
    rows = [(1, "a", None), (1, "a", None), (1, "b", 2.0), (None, "a", 1.0), (None, "a", None)]
    df = spark.createDataFrame(rows, "k INT, v STRING, x DOUBLE")
    assert cleaning.drop_duplicates(df).count() == 4
    keyed = cleaning.drop_duplicates(df, ["k"])
    assert keyed.columns == ["k", "v", "x"]
    assert {tuple(row) for row in keyed.collect()} == {(1, "a", None), (None, "a", None)}
    assert cleaning.drop_duplicates(df, ["k", "v", "x"]).count() == 4


@pytest.fixture(scope="module")
def messy(spark):
    at = ("2019-03-01 10:00:00", "2019-03-01 10:10:00")
    rows = [(1, *at, 1, 1, 10)] * 3 + [
        (2, at[1], at[0], 1, 1, 10),
        (3, at[1], at[0], None, 1, 10),
        (4, *at, None, 1, 10),
        (5, None, None, 1, 1, 10),
        (6, *at, 1, 1, 12),
    ]
    return trips(spark, rows).cache()


def test_report_adds_up(messy):
    steps = {row.rule: row for row in cleaning.cleaning_report(messy).collect()}
    assert [steps[r].rows_removed for r in ("times", "values", "duplicates")] == [3, 1, 2]
    assert [steps[r].rows_in for r in ("times", "values", "duplicates")] == [8, 5, 4]
    assert steps["duplicates"].removed_pct == 50.0
    cleaned = cleaning.clean_trips(messy)
    summary = cleaning.cleaning_summary(cleaning.cleaning_report(messy)).first()
    assert (summary.initial_row_count, summary.cleaned_row_count) == (8, cleaned.count())
    assert summary.rows_removed == 6 and summary.removal_pct == 75.0


def test_report_from_the_cleaned_table(messy):
    cleaned = cleaning.clean_trips(messy)
    assert (
        cleaning.cleaning_report(messy, cleaned=cleaned).collect()
        == cleaning.cleaning_report(messy).collect()
    )


def test_report_with_keys(messy):
    report = cleaning.cleaning_report(messy, keys=["tpep_pickup_datetime"])
    summary = cleaning.cleaning_summary(report).first()
    assert summary.cleaned_row_count == 1
    assert cleaning.clean_trips(messy, keys=["tpep_pickup_datetime"]).count() == 1


def test_clean_is_idempotent_and_a_subset(messy):
    cleaned = cleaning.clean_trips(messy)
    assert ids(cleaned) == [1, 6]
    assert cleaning.clean_trips(cleaned).exceptAll(cleaned).count() == 0
    assert cleaned.exceptAll(messy).count() == 0


def test_empty_table(messy):
    report = cleaning.cleaning_report(messy.filter("false"))
    assert tuple(cleaning.cleaning_summary(report).first()) == (0, 0, 0, 0.0, 0.0)
    assert all(row.rows_removed == 0 and row.removed_pct == 0.0 for row in report.collect())


def test_other_time_names(messy):
    renamed = messy.withColumnsRenamed(
        {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"}
    )
    assert ids(cleaning.clean_trips(renamed)) == [1, 6]
    assert ids(cleaning.clean_trips(renamed.drop("dropoff_datetime"))) == [1, 2, 5, 6]


def test_one_hot_group_of_copies(spark):
    """A third of all rows are copies of one row: they collapse, and are all counted."""
    hot = spark.range(0, 30_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 0, id) AS trip_id",
        "1.0D AS passenger_count",
        "1.0D AS trip_distance",
        "10.0D AS fare_amount",
    )
    summary = cleaning.cleaning_summary(cleaning.cleaning_report(hot)).first()
    assert summary.cleaned_row_count == 20_001
    assert summary.rows_removed == 9_999
    assert cleaning.drop_rare_duplicates(hot).count() == 20_001


def test_rare_duplicates(spark):
    """Copies go, single rows stay; 0.0 and -0.0 are equal."""
    rows = [(1, "a", 0.0), (1, "a", -0.0), (2, None, None), (2, None, None), (3, "c", 1.0), (4, "d", 1.0)]
    df = spark.createDataFrame(rows, "k INT, v STRING, x DOUBLE").repartition(4)
    distinct = cleaning.drop_rare_duplicates(df)
    assert distinct.columns == df.columns
    assert ids(distinct) == [1, 2, 3, 4]


def test_rare_duplicates_shuffle_hashes_only(spark, tmp_path):
    spark.range(100).selectExpr("id", "CAST(id AS STRING) AS s", "id * 2.0D AS x").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = cleaning.drop_rare_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    single, copies = plan.split("LeftAnti")[1].split("LeftSemi")
    assert "Exchange hashpartitioning" not in single.split("HashAggregate")[0]
