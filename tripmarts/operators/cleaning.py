"""Row filters, duplicate removal, and the counts of what was removed and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.functions.rules import all_of, coordinates_ok, times_ok, values_ok
from tripmarts.runtime import cut_lineage
from tripmarts.schemas import CITY_BOUNDS, DROPOFF, MAX_TRIP_HOURS, PICKUP, Bounds

Rules = list[tuple[str, Column]]


def filter_coordinates(
    df: DataFrame,
    lat: str = "pickup_latitude",
    lon: str = "pickup_longitude",
    bounds: Bounds = CITY_BOUNDS,
) -> DataFrame:
    return df.filter(coordinates_ok(lat, lon, bounds))


def filter_times(
    df: DataFrame,
    pickup: str = PICKUP,
    dropoff: str = DROPOFF,
    max_hours: float = MAX_TRIP_HOURS,
) -> DataFrame:
    return df.filter(times_ok(pickup, dropoff, max_hours))


def filter_values(df: DataFrame, **limits: float) -> DataFrame:
    """Keep valid passenger counts, distances and fares; see ``values_ok`` for the limits."""
    return df.filter(values_ok(df.columns, **limits))


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row, or per distinct key.

    With keys, the survivor is the smallest row by the other columns in table
    order, NULLs first. Both forms are aggregates: copies collapse before the
    shuffle, so a key with a large share of all rows sends little.
    """
    rest = [name for name in df.columns if keys is not None and name not in keys]
    if not rest:
        return df.dropDuplicates()
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(
        *[F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in df.columns]
    )


def drop_rare_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows, for large tables where few rows have copies.

    Only the hashes of the rows are shuffled. Rows whose hash occurs once stay where
    they are; the others, copies or not, are compared as a whole. Reads the table
    three times in place of shuffling it, which pays only while the hashes that occur
    twice are few enough for the engine to broadcast; the result is the same for any number.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    counts = hashed.groupBy("_hash").agg(F.count("*").alias("_rows"))
    shared = cut_lineage(counts.filter(F.col("_rows") > 1).select("_hash"))
    single = hashed.join(shared, "_hash", "left_anti").select(*df.columns)
    copies = hashed.join(shared, "_hash", "left_semi").select(*df.columns)
    return single.unionByName(copies.dropDuplicates())


def trip_times(columns: Sequence[str]) -> tuple[str, str] | None:
    """The pickup and dropoff columns under either of their two usual names."""
    pickup = PICKUP if PICKUP in columns else "pickup_datetime"
    dropoff = DROPOFF if DROPOFF in columns else "dropoff_datetime"
    return (pickup, dropoff) if pickup in columns and dropoff in columns else None


def cleaning_rules(
    df: DataFrame,
    *,
    lat: str = "pickup_latitude",
    lon: str = "pickup_longitude",
    bounds: Bounds = CITY_BOUNDS,
    max_hours: float = MAX_TRIP_HOURS,
    **limits: float,
) -> Rules:
    """The row rules that apply to this table's columns, in the order they run."""
    rules: Rules = []
    if lat in df.columns and lon in df.columns:
        rules.append(("coordinates", coordinates_ok(lat, lon, bounds)))
    times = trip_times(df.columns)
    if times:
        rules.append(("times", times_ok(*times, max_hours)))
    rules.append(("values", values_ok(df.columns, **limits)))
    return rules


def clean_trips(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    rare_duplicates: bool = False,
    **options,
) -> DataFrame:
    """Apply every applicable rule as one filter, then remove duplicates.

    ``options`` are those of ``cleaning_rules``. ``rare_duplicates`` picks
    ``drop_rare_duplicates``, which runs its first pass at once.
    """
    kept = df.filter(all_of([rule for _, rule in cleaning_rules(df, **options)]))
    if rare_duplicates and keys is None:
        return drop_rare_duplicates(kept)
    return drop_duplicates(kept, keys)


def reject_reason(rules: Rules) -> Column:
    """Name of the first rule a row breaks, NULL for a row that passes them all."""
    reason = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        broken = ~F.coalesce(rule, F.lit(False))
        reason = F.when(broken, name).otherwise(reason)
    return reason


def _counts(
    df: DataFrame, keys: Sequence[str] | None, rules: Rules, cleaned: DataFrame | None
) -> DataFrame:
    """One row: total rows, rows removed by each rule, and rows kept.

    With the ``cleaned`` table at hand, one scan of the columns the rules use and
    that table's row count give it all. Without it, distinct rows must be counted:
    one scan and one row-sized shuffle, for which rejected rows lose their values
    first, so that each map task sends one row per reason for them.
    """
    reason = reject_reason(rules)
    names = [name for name, _ in rules]
    if cleaned is not None:
        counts = df.select(reason.alias("_reason")).agg(
            F.count("*").alias("_total"),
            *[F.count_if(F.col("_reason") == name).alias(name) for name in names],
        )
        return counts.withColumn("_kept", cleaned.agg(F.count("*")).scalar())
    identity = list(keys) if keys else df.columns
    tagged = df.select(
        reason.alias("_reason"),
        *[F.when(reason.isNull(), F.col(name)).alias(name) for name in identity],
    )
    groups = tagged.groupBy("_reason", *identity).agg(F.count("*").alias("_rows"))
    counts = groups.agg(
        F.sum("_rows").alias("_total"),
        *[F.sum(F.when(F.col("_reason") == name, F.col("_rows"))).alias(name) for name in names],
        F.count_if(F.col("_reason").isNull()).alias("_kept"),
    )
    return counts.na.fill(0)


def cleaning_report(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    cleaned: DataFrame | None = None,
    **options,
) -> DataFrame:
    """One row per cleaning step: rows in, rows removed, and the percentage of the rows in."""
    rules = cleaning_rules(df, **options)
    counts = _counts(df, keys, rules, cleaned)
    remaining, steps = F.col("_total"), []
    for position, (name, _) in enumerate(rules, start=1):
        steps.append(_step(position, name, remaining, F.col(name)))
        remaining = remaining - F.col(name)
    steps.append(_step(len(rules) + 1, "duplicates", remaining, remaining - F.col("_kept")))
    return counts.select(F.inline(F.array(*steps)))


def _step(position: int, name: str, rows_in: Column, removed: Column) -> Column:
    return F.struct(
        F.lit(position).alias("step"),
        F.lit(name).alias("rule"),
        rows_in.alias("rows_in"),
        removed.alias("rows_removed"),
        percent(removed, rows_in).alias("removed_pct"),
    )


def percent(part: Column, whole: Column) -> Column:
    """Percentage, 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def cleaning_summary(report: DataFrame) -> DataFrame:
    """One row from a cleaning report: rows before, after, removed, and percentages."""
    total = F.coalesce(F.max(F.when(F.col("step") == 1, F.col("rows_in"))), F.lit(0))
    counts = report.agg(
        total.alias("initial_row_count"), F.sum("rows_removed").alias("rows_removed")
    )
    initial, removed = F.col("initial_row_count"), F.col("rows_removed")
    return counts.select(
        initial,
        (initial - removed).alias("cleaned_row_count"),
        removed,
        percent(removed, initial).alias("removal_pct"),
        percent(initial - removed, initial).alias("retention_pct"),
    )
