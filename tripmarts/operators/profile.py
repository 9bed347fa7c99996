"""Data quality profile: NULL counts and numeric statistics, one scan each."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.operators.cleaning import percent
from tripmarts.runtime import stored

# Sketch size: some 80 kB, with a rank error within RANK_ERROR.
SKETCH_SIZE = 4096
RANK_ERROR = 0.005
# Sketches merged in one step, so that the tree grows with the number of input splits.
FAN_IN = 64
# Distinct values of a range that one task puts in order.
RANGE_ROWS = 500_000


def _sketch(name: str, size: int) -> Column:
    """Quantile sketch of a numeric column; NaN counts as the largest value, like infinity."""
    value = F.nanvl(F.col(name).cast("double"), F.lit(float("inf")))
    return F.kll_sketch_agg_double(value, F.lit(size))


def _quantiles(sketch: str, fractions: Sequence[float]) -> Column:
    """Array of quantiles, NULL for a sketch that saw no value; NaN where NaN or infinity stands."""
    wanted = F.array(*[F.lit(float(fraction)) for fraction in fractions])
    found = F.kll_sketch_get_quantile_double(sketch, wanted)
    found = F.transform(found, lambda x: F.when(x == float("inf"), float("nan")).otherwise(x))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)


def _in_steps(df: DataFrame, partial: list[Column], merged: list[Column]) -> DataFrame:
    """One row: ``partial`` per input partition, then ``merged`` over ever larger groups of partitions."""
    part = F.spark_partition_id()
    rows = df.groupBy(part.alias("_part")).agg(*partial)
    for _ in range(2):
        rows = rows.groupBy(F.floor(F.col("_part") / FAN_IN).alias("_part")).agg(*merged)
    return rows.agg(*merged)


def _brackets(df: DataFrame, columns: dict[int, str], fractions: Sequence[float], size: int) -> list[tuple]:
    """``column, which, rank, low, high``: for each quantile its rank and the doubles that enclose it, from sketches."""
    wide = [bound for f in fractions for bound in (max(0.0, f - RANK_ERROR), min(1.0, f + RANK_ERROR))]
    sketches = _in_steps(
        df,
        [_sketch(name, size).alias(f"s{i}") for i, name in columns.items()],
        [F.kll_merge_agg_double(f"s{i}", F.lit(size)).alias(f"s{i}") for i in columns],
    )
    wanted = F.array(*map(F.lit, wide))
    count = {i: F.kll_sketch_get_n_double(f"s{i}") for i in columns}
    row = sketches.select(*[
        F.struct(count[i].alias("n"), F.when(count[i] > 0, F.kll_sketch_get_quantile_double(f"s{i}", wanted)).alias("at")).alias(f"b{i}")
        for i in columns
    ]).first()
    return [
        (i, j, max(1, math.ceil(row[f"b{i}"].n * f)), row[f"b{i}"]["at"][2 * j], row[f"b{i}"]["at"][2 * j + 1])
        for i in columns if row[f"b{i}"]["at"] for j, f in enumerate(fractions)
    ]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], size: int = SKETCH_SIZE
) -> dict[str, list]:
    """The value at each fraction of numeric columns, in the column's own type; None for a column without values.

    Infinities come before NaN, NULLs do not count. Sketches give brackets of some 2 * RANK_ERROR of
    the rows; a second scan counts what lies below and inside each, and the values inside are counted
    and put in order over ranges of values, so no task sorts a whole bracket. A bracket that misses
    its rank gives way to all values. Two numbers per quantile and one row per range reach the driver.
    """
    numbered = dict(enumerate(columns))
    kinds = {i: df.schema[name].dataType for i, name in numbered.items()}
    found: dict[tuple[int, int], object] = {}
    brackets = _brackets(df, numbered, fractions, size)
    as_double = {i: F.nanvl(F.col(name).cast("double"), F.lit(float("inf"))) for i, name in numbered.items()}
    if not brackets:
        return {name: [None] * len(fractions) for name in columns}
    counts = df.agg(*[
        F.count_if(condition).alias(f"{part}{n}")
        for n, (i, _, _, low, high) in enumerate(brackets)
        for part, condition in (("below", as_double[i] < low), ("upto", as_double[i] <= high))
    ]).first()
    below = {n: counts[f"below{n}"] for n in range(len(brackets))}
    open_ = []
    for n, (i, j, rank, low, high) in enumerate(brackets):
        if not below[n] < rank <= counts[f"upto{n}"]:
            # The sketch was further off than it mostly is: all values are put in order then.
            brackets[n], below[n] = (i, j, rank, -math.inf, math.inf), 0
        elif low == high and abs(low) < 2.0**53 and not isinstance(kinds[i], T.DecimalType):
            # A bracket of one value that doubles tell from all others is solved.
            found[i, j] = int(low) if isinstance(kinds[i], T.IntegralType) else low
            continue
        open_.append(n)
    groups: dict[str, list[int]] = {}
    for n in open_:
        kind = kinds[brackets[n][0]]
        name = "bigint" if isinstance(kind, T.IntegralType) else "double" if not isinstance(kind, T.DecimalType) else kind.simpleString()
        groups.setdefault(name, []).append(n)
    for kind, members in groups.items():
        inside = [
            F.when((as_double[i] >= low) & (as_double[i] <= high), F.struct(F.lit(n).alias("bracket"), F.col(numbered[i]).cast(kind).alias("value")))
            for n, (i, _, _, low, high) in ((n, brackets[n]) for n in members)
        ]
        rows = df.select(F.inline(F.array_compact(F.array(*inside)))).groupBy("bracket", "value").agg(F.count("*").alias("rows"))
        wanted = {n: brackets[n][2] - below[n] for n in members}
        for n, value in _at_ranks(rows, wanted).items():
            found[brackets[n][:2]] = value
    return {name: [found.get((i, j)) for j in range(len(fractions))] for i, name in numbered.items()}


def _at_ranks(rows: DataFrame, wanted: dict[int, int]) -> dict[int, object]:
    """The value at a rank of each ``bracket`` of ``bracket, value, rows``: ranges first, then the one range that holds it."""
    rows = stored(rows, "ranks")
    parts = max(1, -(-rows.count() // RANGE_ROWS))
    if parts > 1:
        placed = stored(rows.repartitionByRange(parts, "bracket", "value").withColumn("part", F.spark_partition_id()), "ranks")
    else:
        placed = rows.withColumn("part", F.lit(0))
    sums = placed.groupBy("bracket", "part").agg(F.sum("rows").alias("rows")).orderBy("bracket", "part").collect()
    at: dict[int, tuple[int, int]] = {}
    left = dict(wanted)
    for row in sums:
        if row.bracket not in at:
            if left[row.bracket] <= row.rows:
                at[row.bracket] = row.part, left[row.bracket]
            left[row.bracket] -= row.rows
    chosen = [(F.col("bracket") == n) & (F.col("part") == part) for n, (part, _) in at.items()]
    if not chosen:
        return {}
    rank = F.element_at(F.create_map(*[F.lit(x) for n, (_, rank) in at.items() for x in (n, rank)]), F.col("bracket"))
    order = Window.partitionBy("bracket").orderBy("value")
    ranked = placed.filter(reduce(or_, chosen)).withColumn("upto", F.sum("rows").over(order)).filter(F.col("upto") >= rank)
    return {row.bracket: row.value for row in ranked.groupBy("bracket").agg(F.min("value").alias("value")).collect()}


def quantile(df: DataFrame, name: str, fraction: float, size: int = SKETCH_SIZE, exact: bool = False) -> DataFrame:
    """One row, one column ``quantile``: the value at that fraction of the column.

    By sketch, as a double, or exactly in the column's own type; the exact one is computed at once.
    """
    if exact:
        (value,) = exact_quantiles(df.select(name), [name], [fraction], size)[name]
        return df.sparkSession.range(1).select(F.lit(value).cast(df.schema[name].dataType).alias("quantile"))
    sketch = _in_steps(
        df, [_sketch(name, size).alias("_sketch")], [F.kll_merge_agg_double("_sketch", F.lit(size)).alias("_sketch")]
    )
    return sketch.select(F.get(_quantiles("_sketch", [fraction]), F.lit(0)).alias("quantile"))


def _missing(field: T.StructField) -> Column:
    """True where the column is NULL, or NaN if it is numeric."""
    absent = F.col(field.name).isNull()
    return absent | F.isnan(field.name) if isinstance(field.dataType, T.NumericType) else absent


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows that are NULL (or NaN), and their percentage."""
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(_missing(field)).alias(f"missing{i}") for i, field in enumerate(df.schema)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"missing{i}").alias("null_count"),
            percent(F.col(f"missing{i}"), F.col("total")).alias("null_pct"),
        )
        for i, name in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def quality_profile(df: DataFrame, size: int = SKETCH_SIZE, exact: bool = False) -> DataFrame:
    """One row per column: NULLs as in ``null_profile``, and for numeric columns the min,
    max, mean and quartiles (NULL without values), all as doubles.

    One scan for all of it; the quartiles are those of a sketch, or exact (``exact_quantiles``) and computed at once.
    """
    partial = [F.count("*").alias("total")]
    merged = [F.coalesce(F.sum("total"), F.lit(0)).alias("total")]
    rows = []
    for i, field in enumerate(df.schema):
        name, numeric = field.name, isinstance(field.dataType, T.NumericType)
        partial.append(F.count_if(_missing(field)).alias(f"missing{i}"))
        merged.append(F.coalesce(F.sum(f"missing{i}"), F.lit(0)).alias(f"missing{i}"))
        low = high = mean = F.lit(None).cast("double")
        quartiles = F.lit(None).cast("array<double>")
        if numeric:
            value = F.col(name).cast("double")
            partial += [
                F.min(value).alias(f"low{i}"),
                F.max(value).alias(f"high{i}"),
                F.sum(value).alias(f"sum{i}"),
                F.count(value).alias(f"n{i}"),
                *([] if exact else [_sketch(name, size).alias(f"sketch{i}")]),
            ]
            merged += [
                F.min(f"low{i}").alias(f"low{i}"),
                F.max(f"high{i}").alias(f"high{i}"),
                F.sum(f"sum{i}").alias(f"sum{i}"),
                F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}"),
                *([] if exact else [F.kll_merge_agg_double(f"sketch{i}", F.lit(size)).alias(f"sketch{i}")]),
            ]
            low, high = F.col(f"low{i}"), F.col(f"high{i}")
            mean = F.when(F.col(f"n{i}") > 0, F.col(f"sum{i}") / F.col(f"n{i}"))
            quartiles = F.lit(None).cast("array<double>") if exact else _quantiles(f"sketch{i}", [0.25, 0.5, 0.75])
        rows.append(F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"missing{i}").alias("null_count"),
            percent(F.col(f"missing{i}"), F.col("total")).alias("null_pct"),
            low.alias("min"),
            high.alias("max"),
            mean.alias("mean"),
            quartiles.alias("quartiles"),
        ))
    profile = _in_steps(df, partial, merged).select(F.inline(F.array(*rows)))
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if exact and numbers:
        known = exact_quantiles(df.select(*numbers), numbers, [0.25, 0.5, 0.75], size)
        listed = [x for name, values in known.items() for x in (F.lit(name), F.array(*[F.lit(v).cast("double") for v in values]))]
        profile = profile.withColumn("quartiles", F.try_element_at(F.create_map(*listed), F.col("column_name")))
    quartiles = {q: F.get("quartiles", F.lit(i)) for i, q in enumerate(["p25", "p50", "p75"])}
    return profile.withColumns(quartiles).drop("quartiles")


def numeric_profile(df: DataFrame, size: int = SKETCH_SIZE, exact: bool = False) -> DataFrame:
    """The numeric part of ``quality_profile``; reads only the numeric columns."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if not names:
        raise ValueError("the table has no numeric column")
    return quality_profile(df.select(*names), size, exact).drop("null_count", "null_pct")


def dataset_info(df: DataFrame) -> DataFrame:
    """One row: row count, column count, column names and the schema as JSON."""
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*[F.lit(name) for name in df.columns]).alias("columns"),
        F.lit(df.schema.json()).alias("schema_json"),
    )
