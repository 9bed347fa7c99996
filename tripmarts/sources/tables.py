"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmarts.schemas import CENTROID_SCHEMA, ZONE_SCHEMA

FORMATS = ("parquet", "csv", "json")
GIBIBYTE = 1024**3


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob names anything, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(system.globStatus(target) or []) > 0


def _require(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)


def read_trips(
    spark: SparkSession, path: str, pattern: str = "*.parquet", merge_schema: bool = False
) -> DataFrame:
    """All Parquet files of a folder whose names match the pattern, as one table."""
    _require(spark, path)
    return (
        spark.read.option("pathGlobFilter", pattern)
        .option("mergeSchema", str(merge_schema).lower())
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A processed Parquet table."""
    _require(spark, path)
    return spark.read.parquet(path)


def widest(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that holds values of all these: the widest number, or text if they are of different sorts."""
    kinds = list(dict.fromkeys(kind for kind in kinds if not isinstance(kind, T.NullType))) or [T.NullType()]
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        return T.LongType()
    if all(isinstance(kind, T.DecimalType | T.IntegralType) for kind in kinds):
        decimals = [kind if isinstance(kind, T.DecimalType) else T.DecimalType(20, 0) for kind in kinds]
        scale = max(kind.scale for kind in decimals)
        return T.DecimalType(min(38, scale + max(kind.precision - kind.scale for kind in decimals)), scale)
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        return T.DoubleType()
    if all(isinstance(kind, T.DateType | T.TimestampNTZType) for kind in kinds):
        return T.TimestampNTZType()
    return T.StringType()


def read_drifted(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All Parquet files of a folder as one table, though columns and types changed between them.

    Files are grouped by the schema in their footers and each group is one scan, so filters and
    column choices still reach the files. Columns are matched by name, in order of first appearance;
    one that a file lacks is NULL there, and a column of several types becomes ``widest`` of them.
    Only file names and footers are read before the scan.
    """
    _require(spark, path)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    files = sorted(row.path for row in listed.select("path").collect())
    if not files:
        raise FileNotFoundError(f"{path}/{pattern}")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file in files:
        schema = spark.read.parquet(file).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    kinds: dict[str, list[T.DataType]] = {}
    for schema, _ in groups.values():
        for field in schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    parts = [
        spark.read.schema(schema).parquet(*members).select(*[
            (F.col(name) if name in schema.names else F.lit(None)).cast(widest(kinds[name])).alias(name) for name in kinds
        ])
        for schema, members in groups.values()
    ]
    return reduce(DataFrame.unionByName, parts)


def read_features_or_raw(spark: SparkSession, features: str, raw: str) -> DataFrame:
    """The table with features if it exists, else the raw trips."""
    if path_exists(spark, features):
        return read_table(spark, features)
    return read_trips(spark, raw)


def _read_by_name(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV columns by the names in the header, in any order and case; other columns are left out.

    A missing column is an error. Values that do not fit a column's type are NULL.
    """
    fields = T.StructType.fromDDL(schema)
    raw = spark.read.option("header", True).csv(path)
    names = {name.lower(): name for name in raw.columns}
    missing = [field.name for field in fields if field.name.lower() not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[
        F.col(f"`{names[field.name.lower()]}`").try_cast(field.dataType).alias(field.name) for field in fields
    ])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone names: (LocationID, Zone, Borough)."""
    _require(spark, path)
    return _read_by_name(spark, path, ZONE_SCHEMA)


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Zone centroids: (LocationID, latitude, longitude)."""
    _require(spark, path)
    return _read_by_name(spark, path, CENTROID_SCHEMA)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Write as Parquet, CSV with a header, or JSON lines."""
    if fmt not in FORMATS:
        raise ValueError(f"cannot write {fmt}: use one of {FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_sample(df: DataFrame, path: str, order: Sequence[str] = (), n: int = 10) -> None:
    """n rows as one CSV file with a header: the first in the given order, or any n.

    Without an order, reading stops after the first splits that give n rows.
    """
    rows = (df.orderBy(*order) if order else df).take(n)
    write_table(df.sparkSession.createDataFrame(rows, df.schema).coalesce(1), path, fmt="csv")


def print_table(df: DataFrame, n: int = 5) -> None:
    """Print the schema and n rows."""
    df.printSchema()
    df.show(n, truncate=False)


def write_report(df: DataFrame, path: str) -> None:
    """A small result as one JSON-lines file; NULLs stay in it."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_centers(centers: DataFrame, path: str) -> None:
    """Cluster centres as one CSV file with a header, in cluster order."""
    write_table(centers.coalesce(1).sortWithinPartitions("cluster"), path, fmt="csv")


def clustered_trips(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """The columns a clustered trip table keeps."""
    return df.select(
        "PULocationID", "latitude", "longitude", cluster, "fare_amount", "total_revenue"
    )


def audit_files(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """One row per expected table: ``is_present`` (exists and is not empty) and its bytes.

    A table is a file or a folder of part files. Lists the folder without opening the files.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    below = F.substring_index("path", f"{root}/", -1)
    found = listed.groupBy(F.substring_index(below, "/", 1).alias("file")).agg(F.sum("length").alias("length"))
    wanted = spark.createDataFrame([(name,) for name in expected], "file STRING")
    return wanted.join(found, "file", "left").select(
        "file",
        (F.coalesce("length", F.lit(0)) > 0).alias("is_present"),
        F.coalesce("length", F.lit(0)).alias("bytes"),
    )


def audit_rows(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """One row per input file of each expected Parquet table: ``table, file, n_rows, bytes, is_present``.

    Counts come from the files' own rows through Spark's hidden ``_metadata`` columns. An expected
    table that is missing, or that holds no row, has one row without a file.
    """
    wanted = spark.createDataFrame([(name,) for name in expected], "table STRING")
    found = [
        read_table(spark, f"{folder}/{name}")
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("bytes"))
        .select(F.lit(name).alias("table"), "file", "n_rows", "bytes")
        for name in dict.fromkeys(expected) if path_exists(spark, f"{folder}/{name}")
    ]
    empty = spark.createDataFrame([], "table STRING, file STRING, n_rows BIGINT, bytes BIGINT")
    counted = reduce(DataFrame.unionByName, found, empty)
    return wanted.join(counted, "table", "left").select(
        "table", "file", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.col("file").isNotNull().alias("is_present"),
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    """One row: expected files, present files, their size in GB, and the missing names."""
    return audit.agg(
        F.count("*").alias("total_files"),
        F.count_if("is_present").alias("existing_files"),
        (F.sum("bytes") / GIBIBYTE).alias("total_size_gb"),
        F.sort_array(F.collect_list(F.when(~F.col("is_present"), F.col("file")))).alias("missing_files"),
    )
