"""Where streams write. Every query has a checkpoint of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmarts.sources.tables import path_exists

DONE = {"availableNow": True}
EVERY_5_SECONDS = {"processingTime": "5 seconds"}
# Running results kept at a time, unless the caller asks for more.
SLOTS = 10


def to_console(df: DataFrame, checkpoint: str, trigger: dict = EVERY_5_SECONDS) -> StreamingQuery:
    """Print the whole running result, 20 rows of it, on every trigger."""
    return (
        df.writeStream.outputMode("complete")
        .format("console")
        .option("truncate", "false")
        .option("numRows", 20)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def to_table(df: DataFrame, path: str, checkpoint: str, trigger: dict = EVERY_5_SECONDS) -> StreamingQuery:
    """Append the rows to a Parquet table; the sink's log makes a repeated batch harmless."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def to_snapshots(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = EVERY_5_SECONDS,
    files: int | None = None,
    slots: int = SLOTS,
) -> StreamingQuery:
    """Write the whole running result of each batch into the next of a ring of ``slots`` partitions.

    ``path`` belongs to one checkpoint: batch numbers tell which result is the latest.

    A batch that is repeated after a failure replaces only what it wrote itself, and
    a result stays readable until the ring comes round. ``files`` per batch are for a
    result with few groups; by default there is one per state partition.
    """

    def write(result: DataFrame, batch: int) -> None:
        numbered = result.withColumn("batch", F.lit(batch).cast("bigint"))
        if files is not None:
            numbered = numbered.repartition(files)
        numbered.write.mode("overwrite").parquet(f"{path}/slot={batch % slots}")

    return (
        df.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def to_batch_counts(
    df: DataFrame, path: str, checkpoint: str, trigger: dict = EVERY_5_SECONDS
) -> StreamingQuery:
    """Record the pace: a row (batch, n_rows) for each batch. A repeated batch replaces its own row."""

    def write(rows: DataFrame, batch: int) -> None:
        count = rows.agg(F.count("*").alias("n_rows")).select(F.lit(batch).cast("bigint").alias("batch"), "n_rows")
        count.write.mode("overwrite").parquet(f"{path}/of_batch={batch}")

    return (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def latest_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The running result of the last batch; with a schema, empty if no batch has been written.

    A running result only grows, so the last batch is the last one with rows.
    """
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    snapshots = spark.read.parquet(path)
    last = snapshots.agg(F.max("batch")).scalar()
    return snapshots.filter(F.col("batch") == last).drop("batch", "slot")
