"""Where a job may keep intermediate tables, and how it cuts a long lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a temporary folder; a cluster without
    the setting is an error, since a machine-local folder is lost with its machine.
    ``local-cluster`` counts as a cluster. A ``file:`` folder is taken as given: it may be a
    mount that all machines share. Everything lies below ``<folder>/tripmarts`` or in the
    engine's checkpoint folders; :func:`remove_work` deletes the former.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tripmarts-")
    context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/tripmarts/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, read back after an executor is lost."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows computed once, as a table below the shared folder."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_work(spark: SparkSession) -> None:
    """Delete the tables below the shared folder; no result that still reads them may be in use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tripmarts")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
