"""Reproducible samples and splits.

Spark's own ``sample`` and ``randomSplit`` depend on how the rows are partitioned.
The hash forms decide by a row's key alone, so a rerun, another cluster size or a
retried task gives the same rows. The key should identify a row: rows that share a
key are taken or left together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.schemas import SEED, TEST_FRACTION

BUCKETS = 1_000_000


def key_hash(keys: Sequence[str], seed: int = SEED) -> Column:
    """MD5 of ``seed|key|key``, a NULL key as nothing: the same in any engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]))


def _bucket(keys: Sequence[str], seed: int) -> Column:
    number = F.conv(F.substring(key_hash(keys, seed), 1, 12), 16, 10).cast("bigint")
    return number % BUCKETS


def _check(fraction: float) -> None:
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must be between 0 and 1, not {fraction}")


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = SEED) -> DataFrame:
    """About that fraction of the rows, chosen by key."""
    _check(fraction)
    return df.filter(_bucket(keys, seed) < round(fraction * BUCKETS))


def in_test_part(keys: Sequence[str], fraction: float = TEST_FRACTION, seed: int = SEED) -> Column:
    """True for the rows of the test part."""
    _check(fraction)
    return _bucket(keys, seed) >= round((1 - fraction) * BUCKETS)


def hash_split(
    df: DataFrame, keys: Sequence[str], fraction: float = TEST_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, and together all rows."""
    test = in_test_part(keys, fraction, seed)
    return df.filter(~test), df.filter(test)


def fixed_sample(df: DataFrame, keys: Sequence[str], rows: int, seed: int = SEED) -> DataFrame:
    """As many rows as asked for, or all: those of the smallest key hashes, equal ones by key.

    Every partition passes on that many rows at most. A larger sample holds a smaller one.
    """
    if rows < 0:
        raise ValueError(f"rows must not be negative, not {rows}")
    return df.orderBy(key_hash(keys, seed), *keys).limit(rows)


def random_sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Seeded Bernoulli sample for rows without a key; depends on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
