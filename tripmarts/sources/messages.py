"""Trip rows as JSON messages, for a topic or a file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.functions.features import iso_text

PLAIN = (T.NumericType, T.StringType, T.BooleanType)


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row in the column ``value``.

    Times are ISO 8601 text, other types without a JSON form are plain text, and
    NULLs stay as JSON null.
    """
    fields = []
    for field in df.schema:
        name = field.name
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            fields.append(iso_text(name).alias(name))
        elif isinstance(field.dataType, T.DecimalType) or not isinstance(field.dataType, PLAIN):
            fields.append(F.col(name).cast("string").alias(name))
        else:
            fields.append(F.col(name))
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def replay_rows(
    spark: SparkSession, path: str, order: Sequence[str], max_rows: int | None = None
) -> DataFrame:
    """Rows of one Parquet file in a fixed order, optionally only the first ``max_rows``."""
    rows = spark.read.parquet(path).orderBy(*order)
    return rows if max_rows is None else rows.limit(max_rows)
