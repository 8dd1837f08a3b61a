"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark removes a query's shuffle files when the query has ended, instead of when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of our own if the whole of Spark is this machine, and an error otherwise."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        have = "file://" + tempfile.mkdtemp(prefix="textmill-")
        spark.conf.set("spark.checkpoint.dir", have)
    return have.rstrip("/")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame) -> DataFrame:
    """df as a table written to the shared folder: an executor that is lost costs a reread.

    The shuffle files that only the writing needed go at once, the table when the application ends
    or with ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    if before is not None:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)
    p, files = _path(spark, path)
    files.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more, since a later one has what came of it."""
    p, files = _path(df.sparkSession, df._written_to)
    files.delete(p, True)
