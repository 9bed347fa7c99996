from __future__ import annotations

import decimal
import math

import pytest

from tripmarts.operators import profile

SCHEMA = "a INT, b DOUBLE, c DOUBLE, s STRING, d DECIMAL(10,2)"


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 1.0, None, "x", None), (2, float("nan"), None, None, None), (None, 3.0, None, "y", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_nulls(table):
    counts = {r.column_name: r.null_count for r in profile.null_profile(table).collect()}
    assert counts == {"a": 1, "b": 1, "c": 3, "s": 1, "d": 3}


def test_numbers(table):
    rows = {r.column_name: r for r in profile.numeric_profile(table).collect()}
    assert set(rows) == {"a", "b", "c", "d"}
    assert (rows["a"].min, rows["a"].max, rows["a"].mean, rows["a"].p50) == (1.0, 2.0, 1.5, 1.0)
    assert math.isnan(rows["b"].max)
    assert rows["b"].p25 == 1.0 and rows["b"].p50 == 3.0
    for name in ("c", "d"):
        assert tuple(rows[name])[1:] == (None,) * 6


def test_whole_profile(table):
    rows = {r.column_name: r for r in profile.quality_profile(table).collect()}
    assert list(rows) == ["a", "b", "c", "s", "d"]
    assert rows["s"].null_count == 1 and rows["s"].min is None
    assert round(rows["a"].null_pct, 6) == 33.333333


def test_empty_table(table):
    rows = profile.quality_profile(table.filter("false")).collect()
    assert all(r.null_count == 0 and r.null_pct == 0.0 and r.p50 is None for r in rows)
    assert profile.null_profile(table.filter("false")).first().null_pct == 0.0
    assert profile.dataset_info(table.filter("false")).first().row_count == 0


def test_no_numbers(table):
    with pytest.raises(ValueError):
        profile.numeric_profile(table.select("s"))


def test_quantile_of_many_values(spark):
    df = spark.range(0, 400_000, 1, 16).selectExpr("CAST(id AS DOUBLE) AS x")
    value = profile.quantile(df, "x", 0.75).first()[0]
    assert abs(value - 300_000) < 400_000 * 0.001


def test_exact_quantiles(spark):
    df = spark.range(0, 100_000, 1, 16).selectExpr("id % 777 AS a", "IF(id % 1000 = 0, NULL, id * id * 1.0D) AS b", "0 AS c")
    rows = {r.column_name: r for r in profile.numeric_profile(df, exact=True).collect()}
    values = sorted(i * i * 1.0 for i in range(100_000) if i % 1000)
    assert [rows["b"].p25, rows["b"].p50, rows["b"].p75] == [values[-(-len(values) * q // 4) - 1] for q in (1, 2, 3)]
    assert (rows["c"].p25, rows["c"].p75) == (0.0, 0.0)
    assert profile.quantile(df, "b", 0.5, exact=True).first()[0] == rows["b"].p50
    assert profile.quantile(df.filter("false"), "b", 0.5, exact=True).first()[0] is None


def test_sketches_are_small(spark):
    df = spark.range(0, 300_000, 1, 4).selectExpr("CAST(id AS DOUBLE) AS x")
    size = df.agg(profile._sketch("x", profile.SKETCH_SIZE).alias("s")).selectExpr("octet_length(s)").first()[0]
    assert size < 200_000


def test_nan_stays_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("nan"),)], "x DOUBLE")
    for exact in (False, True):
        row = profile.numeric_profile(df, exact=exact).first()
        assert math.isnan(row.p50) and math.isnan(row.max) and row.p25 == 1.0


def test_info(table):
    info = profile.dataset_info(table).first()
    assert (info.row_count, info.column_count, info.columns) == (3, 5, ["a", "b", "c", "s", "d"])
    assert '"name":"a"' in info.schema_json


def test_exact_quantiles_in_the_columns_type(spark, monkeypatch):
    monkeypatch.setattr(profile, "RANGE_ROWS", 300)
    big = 2**60
    rows = [(big + n % 1000, decimal.Decimal(n) / 1000, float(n % 300), None) for n in range(4000)]
    rows += [(None, None, float("nan"), None)] * 50 + [(None, None, float("inf"), None)] * 50
    df = spark.createDataFrame(rows, "a BIGINT, d DECIMAL(12,3), x DOUBLE, e INT").repartition(5)
    fractions = [0.0, 0.25, 0.5, 0.985, 1.0]
    found = profile.exact_quantiles(df, df.columns, fractions, 64)

    def expected(values):
        values = sorted(values)
        return [values[max(1, math.ceil(len(values) * f)) - 1] for f in fractions]

    assert found["a"] == expected([r[0] for r in rows if r[0]])
    assert found["d"] == expected([r[1] for r in rows if r[1] is not None])
    known = expected([(math.isnan(r[2]), r[2]) for r in rows])
    assert [str(x) for x in found["x"]] == [str(x) for _, x in known]
    assert found["x"][3] == float("inf") and math.isnan(found["x"][4])
    assert found["e"] == [None] * 5
