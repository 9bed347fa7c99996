from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tripmarts import runtime
from tripmarts.sources import messages, tables


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(2, "b", 1.5), (1, "a", None)], "id INT, s STRING, x DOUBLE")


def test_pattern_selects_files(rows, spark, tmp_path):
    rows.coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("part-*.parquet"))
    (tmp_path / "raw").mkdir()
    for name in ("trips_1.parquet", "trips_2.parquet", "other.parquet"):
        (tmp_path / "raw" / name).write_bytes(part.read_bytes())
    raw = str(tmp_path / "raw")
    assert tables.read_trips(spark, raw).count() == 6
    assert tables.read_trips(spark, raw, "trips_*.parquet").count() == 4


def test_merged_schema(rows, spark, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    rows.withColumn("extra", F.lit(1)).write.mode("append").parquet(str(tmp_path / "t"))
    merged = tables.read_trips(spark, str(tmp_path / "t"), merge_schema=True)
    assert merged.columns == ["id", "s", "x", "extra"] and merged.filter("extra IS NULL").count() == 2


@pytest.mark.parametrize("reader", [tables.read_trips, tables.read_table, tables.read_zones, tables.read_centroids])
def test_missing_path(spark, tmp_path, reader):
    with pytest.raises(FileNotFoundError):
        reader(spark, str(tmp_path / "nothing"))


def test_features_or_raw(rows, spark, tmp_path):
    raw, features = str(tmp_path / "raw"), str(tmp_path / "features")
    rows.write.parquet(raw)
    assert tables.read_features_or_raw(spark, features, raw).columns == rows.columns
    rows.withColumn("f", F.lit(1)).write.parquet(features)
    assert "f" in tables.read_features_or_raw(spark, features, raw).columns


def test_zone_files(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Zone,Borough\n1,Alpha,North\n2,\"Beta, East\",South\n")
    (tmp_path / "points.csv").write_text("LocationID,latitude,longitude\n1,40.5,-74.1\n")
    zones = tables.read_zones(spark, str(tmp_path / "zones.csv"))
    assert zones.dtypes == [("LocationID", "int"), ("Zone", "string"), ("Borough", "string")]
    assert {tuple(r) for r in zones.collect()} == {(1, "Alpha", "North"), (2, "Beta, East", "South")}
    assert [tuple(r) for r in tables.read_centroids(spark, str(tmp_path / "points.csv")).collect()] == [(1, 40.5, -74.1)]


@pytest.mark.parametrize("fmt", tables.FORMATS)
def test_write_formats(rows, spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    tables.write_table(rows, path, fmt=fmt)
    reader = spark.read.schema(rows.schema).format(fmt)
    back = (reader.option("header", True) if fmt == "csv" else reader).load(path)
    assert back.exceptAll(rows).count() == 0 and back.count() == 2
    tables.write_table(rows, path, mode="append", fmt=fmt)
    assert spark.read.schema(rows.schema).format(fmt).option("header", True).load(path).count() == 4
    tables.write_table(rows, path, mode="ignore", fmt=fmt)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        tables.write_table(rows, path, mode="error", fmt=fmt)


def test_other_format(rows, tmp_path):
    with pytest.raises(ValueError):
        tables.write_table(rows, str(tmp_path / "x"), fmt="xlsx")


def test_partitioned_write(rows, spark, tmp_path):
    tables.write_table(rows, str(tmp_path / "p"), partition_by=["s"])
    assert {p.name for p in (tmp_path / "p").glob("s=*")} == {"s=a", "s=b"}


def test_sample_file(rows, tmp_path):
    tables.write_sample(rows, str(tmp_path / "sample"), ["id"], 1)
    (part,) = (tmp_path / "sample").glob("part-*.csv")
    assert part.read_text().splitlines() == ["id,s,x", "1,a,"]
    tables.write_sample(rows, str(tmp_path / "any"))
    (part,) = (tmp_path / "any").glob("part-*.csv")
    assert len(part.read_text().splitlines()) == 3


def test_print(rows, capsys):
    tables.print_table(rows, 1)
    out = capsys.readouterr().out
    assert "id: integer" in out and "only showing top 1 row" in out


def test_report_keeps_nulls(rows, tmp_path):
    tables.write_report(rows, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*.json")
    assert {"id": 1, "s": "a", "x": None} in [json.loads(line) for line in part.read_text().splitlines()]


def test_centers_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0), (0, 1.0, 2.0)], "cluster INT, latitude DOUBLE, longitude DOUBLE")
    tables.write_centers(df, str(tmp_path / "centers"))
    (part,) = (tmp_path / "centers").glob("part-*.csv")
    assert part.read_text().splitlines() == ["cluster,latitude,longitude", "0,1.0,2.0", "1,2.0,3.0"]


def test_audit(spark, tmp_path):
    (tmp_path / "full.bin").write_bytes(b"x" * 2048)
    (tmp_path / "empty.bin").write_bytes(b"")
    audit = tables.audit_files(spark, str(tmp_path), ["full.bin", "empty.bin", "gone.bin"])
    assert {r.file: (r.is_present, r.bytes) for r in audit.collect()} == {
        "full.bin": (True, 2048), "empty.bin": (False, 0), "gone.bin": (False, 0)
    }
    summary = tables.audit_summary(audit).first()
    assert (summary.total_files, summary.existing_files) == (3, 1)
    assert summary.total_size_gb == 2048 / 1024**3
    assert summary.missing_files == ["empty.bin", "gone.bin"]


def test_audit_of_table_folders(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "t.parquet"))
    row = tables.audit_files(spark, str(tmp_path), ["t.parquet"]).first()
    assert row.is_present and row.bytes > 0
    assert tables.read_trips(spark, str(tmp_path / "t.parquet")).count() == 10


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("borough,extra,LOCATIONID,Zone,service_zone\nEWR,1,1,Airport,x\n,2,bad,Y,z\n")
    rows = tables.read_zones(spark, str(tmp_path / "zones.csv")).collect()
    assert [(r.LocationID, r.Zone, r.Borough) for r in rows] == [(1, "Airport", "EWR"), (None, "Y", None)]
    (tmp_path / "points.csv").write_text("longitude,LocationID\n1.5,2\n")
    with pytest.raises(ValueError, match="latitude"):
        tables.read_centroids(spark, str(tmp_path / "points.csv"))


def test_messages(spark):
    df = spark.sql("""SELECT 1 AS id, TIMESTAMP_NTZ'2019-03-01 00:22:19' AS t, TIMESTAMP_NTZ'2019-03-10 02:30:00.12' AS u,
        CAST(NULL AS DOUBLE) AS x, DATE'2019-03-01' AS d, true AS b, 'q"' AS s, CAST(1.50 AS DECIMAL(5,2)) AS m""")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        value = messages.to_messages(df).first().value
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert json.loads(value) == {
        "id": 1,
        "t": "2019-03-01T00:22:19",
        "u": "2019-03-10T02:30:00.120000",
        "x": None,
        "d": "2019-03-01",
        "b": True,
        "s": 'q"',
        "m": "1.50",
    }


def test_replay(rows, spark, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    assert [r.id for r in messages.replay_rows(spark, str(tmp_path / "t"), ["id"], 1).collect()] == [1]
    assert messages.replay_rows(spark, str(tmp_path / "t"), ["id"]).count() == 2


def test_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert runtime.shared_folder(spark) == folder.rstrip("/")
    assert runtime.work_path(spark, "a").startswith(folder)
    assert runtime.work_path(spark, "a") != runtime.work_path(spark, "a")


def test_cut_lineage(spark):
    df = runtime.cut_lineage(spark.range(10).selectExpr("id % 3 AS k").groupBy("k").count())
    assert df.count() == 3
    assert "HashAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_drifted_files_by_name_with_widened_types(spark, tmp_path):
    spark.createDataFrame([(1, 2, "a")], "id INT, fee INT, name STRING").write.parquet(f"{tmp_path}/t/a")
    spark.createDataFrame([(2**40, 2.5)], "id BIGINT, fee DOUBLE").write.parquet(f"{tmp_path}/t/b")
    spark.createDataFrame([("x", 3, 4)], "name STRING, extra INT, id INT").write.parquet(f"{tmp_path}/t/c")
    df = tables.read_drifted(spark, f"{tmp_path}/t")
    assert dict(df.dtypes) == {"id": "bigint", "fee": "double", "name": "string", "extra": "int"}
    rows = sorted((r.id, r.fee, r.name, r.extra) for r in df.collect())
    assert rows == [(1, 2.0, "a", None), (4, None, "x", 3), (2**40, 2.5, None, None)]
    assert [r.id for r in df.filter("fee > 2").collect()] == [2**40]
    with pytest.raises(FileNotFoundError):
        tables.read_drifted(spark, f"{tmp_path}/nothing")


def test_widest_types():
    assert tables.widest([T.IntegerType(), T.ShortType()]) == T.LongType()
    assert tables.widest([T.DecimalType(10, 2), T.IntegerType()]) == T.DecimalType(22, 2)
    assert tables.widest([T.DateType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert tables.widest([T.DateType(), T.LongType()]) == T.StringType()


def test_rows_behind_each_file(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/a.parquet")
    found = tables.audit_rows(spark, str(tmp_path), ["a.parquet", "b.parquet"]).collect()
    held = [r for r in found if r.table == "a.parquet"]
    assert len(held) == 2 and sum(r.n_rows for r in held) == 10 and all(r.bytes > 0 and r.is_present for r in held)
    assert [(r.file, r.n_rows, r.bytes, r.is_present) for r in found if r.table == "b.parquet"] == [(None, 0, 0, False)]
