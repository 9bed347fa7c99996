"""Joins of large trip tables with zone dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.schemas import LOCATION

# A dimension is broadcast only when it was measured to be within both limits.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def _width(field: T.StructField) -> Column:
    """Bytes of a value: the length of a text, 8 of a plain number or time, else its JSON text."""
    name = field.name
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(name)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(name)))
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0))


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is within both limits, by one aggregation that moves no rows."""
    width = F.lit(0).cast("bigint")
    for field in df.schema:
        width = width + _width(field)
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    how: str = "inner",
    *,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner or left join of facts with a dimension; all columns of both sides remain.

    A dimension measured to be small carries a broadcast hint, so the facts are not shuffled.
    Any other is a plain equi-join with the same columns: a key with a large share of the facts
    is split by adaptive execution, into as many parts as its measured size needs.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type must be inner or left, not {how}")
    side = F.broadcast(dimension) if is_small(dimension, max_rows) else dimension.hint("merge")
    return facts.join(side, facts[fact_key] == side[dimension_key], how)


def join_zones(trips: DataFrame, zones: DataFrame, location: str = LOCATION) -> DataFrame:
    """Left join with the zone names; unchanged if either key column is missing."""
    key = "LocationID" if "LocationID" in zones.columns else "locationid"
    if location not in trips.columns or key not in zones.columns:
        return trips
    return join_dimension(trips, zones, location, key, "left")


def attach_centroids(trips: DataFrame, centroids: DataFrame, location: str = LOCATION) -> DataFrame:
    """Inner join with the zone centroids; trips from unmapped locations are dropped."""
    points = centroids.withColumnRenamed("LocationID", "_zone_id")
    return join_dimension(trips, points, location, "_zone_id").drop("_zone_id")


def add_zone_label(df: DataFrame, zones: DataFrame, location: str = LOCATION) -> DataFrame:
    """``zone_label``: the zone's name, or ``Loc <id>`` for an id without one."""
    names = zones.select(F.col("LocationID").alias("_zone_id"), F.col("Zone").alias("_zone_name"))
    labelled = join_dimension(df, names, location, "_zone_id", "left")
    fallback = F.concat(F.lit("Loc "), F.col(location).cast("string"))
    return labelled.withColumn("zone_label", F.coalesce("_zone_name", fallback)).drop(
        "_zone_id", "_zone_name"
    )
