from __future__ import annotations

import pytest

from tripmarts.operators import sampling


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 20_000, 1, 8).withColumnRenamed("id", "trip_id")


def test_sample_does_not_depend_on_partitions(rows):
    first = sampling.hash_sample(rows, ["trip_id"], 0.1)
    second = sampling.hash_sample(rows.repartition(3), ["trip_id"], 0.1)
    assert first.exceptAll(second).count() == 0
    assert abs(first.count() - 2000) < 200
    assert sampling.hash_sample(rows, ["trip_id"], 0.1, seed=1).exceptAll(first).count() > 0


@pytest.mark.parametrize(("fraction", "expected"), [(0, 0), (1, 20_000)])
def test_ends(rows, fraction, expected):
    assert sampling.hash_sample(rows, ["trip_id"], fraction).count() == expected


def test_split_is_disjoint_and_whole(rows):
    train, test = sampling.hash_split(rows, ["trip_id"])
    assert train.intersect(test).count() == 0
    assert train.unionByName(test).exceptAll(rows).count() == 0
    assert train.count() + test.count() == 20_000
    assert abs(test.count() - 4000) < 300


def test_random_sample(rows):
    assert sampling.random_sample(rows, 0.1).collect() == sampling.random_sample(rows, 0.1).collect()


def test_bad_fraction(rows):
    with pytest.raises(ValueError):
        sampling.hash_sample(rows, ["trip_id"], 1.5)


def test_fixed_sample_is_nested_and_does_not_depend_on_partitions(rows):
    first = {r.trip_id for r in sampling.fixed_sample(rows, ["trip_id"], 500).collect()}
    second = {r.trip_id for r in sampling.fixed_sample(rows.repartition(3), ["trip_id"], 900).collect()}
    assert len(first) == 500 and len(second) == 900 and first < second
    assert sampling.fixed_sample(rows, ["trip_id"], 0).count() == 0
    assert sampling.fixed_sample(rows.limit(7), ["trip_id"], 10).count() == 7
    with pytest.raises(ValueError):
        sampling.fixed_sample(rows, ["trip_id"], -1)
