"""What several operators share: reading tables, words, and steps kept in the shared folder."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmarts.runtime import work_path

# Words are runs of characters that are not one of these six.
GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written to the shared folder and read from there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text as an array; NULL and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda word: word != "")


def count_of(rows: int, per_part: int) -> int:
    """Parts of about ``per_part`` rows each."""
    return max(1, -(-rows // per_part))


# Rows of a key that one task of a join may meet: this many, or a ten-thousandth of all.
HOT_ROWS, HOT_KEYS = 1_000, 10_000


def looked_up(rows: DataFrame, values: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``values``, whose keys are unique; NULL where there is none.

    Keys of very many rows, HOT_KEYS of them at most, are broadcast with their values; all others
    are an equi-join. Both tables are read twice, so they should be kept ones.
    """
    total = rows.count()
    counts = rows.groupBy(*on).agg(F.count("*").alias("_rows"))
    hot = kept(counts.filter(F.col("_rows") > max(HOT_ROWS, total // HOT_KEYS)).select(*on), "hot")
    hot = F.broadcast(hot)
    frequent = rows.join(hot, on, "left_semi").join(F.broadcast(values.join(hot, on, "left_semi")), on, "left")
    return frequent.unionByName(rows.join(hot, on, "left_anti").join(values.join(hot, on, "left_anti"), on, "left"))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if getattr(context, "_tripmarts_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="tripmarts-")
    context.addPyFile(shutil.make_archive(f"{folder}/tripmarts", "zip", package.parent, package.name))
    context._tripmarts_shipped = True
