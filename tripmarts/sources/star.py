"""Trip tables derived from a star schema of orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per event; the number in ``props`` decides its length and its flaws."""
    k = F.col("k")
    # Cut from {"k": 12} by two searches: rules on k reach the filter, which repeats this per rule.
    number = F.substring_index(F.substring_index("props", ":", -1), "}", 1)
    events = table(spark, folder, "events").withColumn("k", number.cast("bigint"))
    return events.select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr("ts + k * INTERVAL '1' MINUTE").alias("tpep_dropoff_datetime"),
        (F.col("user_id") % 30).alias("PULocationID"),
        F.when(k % 7 != 6, (k % 7).cast("double")).alias("passenger_count"),
        F.when(k % 50 == 49, -1.0).otherwise(k.cast("double") / 10).alias("trip_distance"),
        F.when((F.col("event_type") == "error") & (k % 10 == 0), -F.col("value"))
        .otherwise(F.col("value"))
        .alias("fare_amount"),
        F.when(F.col("event_type") == "purchase", F.col("value") * 0.2)
        .otherwise(0.0)
        .alias("tip_amount"),
    )


def order_trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per order line: from the order date to the ship date, located at the supplier."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_quantity").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tip_amount"),
    )


def nation_zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per nation, its region as the borough."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("Borough"),
    )


def nation_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """A point per nation on a line of 20, so that some zones share one."""
    step = F.col("n_nationkey") % 20
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("LocationID"),
        (40.5 + step * 0.015).alias("latitude"),
        (-74.2 + step * 0.02).alias("longitude"),
    )


def supplier_zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per supplier; this dimension grows with the data."""
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("LocationID"),
        F.col("s_name").alias("Zone"),
        F.col("n_name").alias("Borough"),
    )
