"""Files of a folder as a stream: the same maps and filters, state only where a first occurrence must be known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def documents(spark: SparkSession, path: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clean(df: DataFrame, least_words: int = 15) -> DataFrame:
    """Stateless: non-empty documents of enough words."""
    return df.where(F.col("text").rlike(r"(?U)\S")).where(F.size(F.split("text", " ")) >= least_words)


def first_texts(df: DataFrame, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Documents whose text was not seen before; with an event time, within the delay, so that state is bounded."""
    keyed = df.withColumn("key", F.md5(T.unicode_strip(F.col("text"))))
    if time is None:
        return keyed.dropDuplicates(["key"]).drop("key")
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["key"]).drop("key")


def shuffled(df: DataFrame, id_col: str = "doc_id", seed: int = 42, buffer: int = 10_000):
    """For foreachBatch: each batch, of as many rows as the files it holds, in the order of a hash; ``buffer`` bounds what write_shuffled sorts at once."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(buffer)


def write_shuffled(df: DataFrame, path: str, checkpoint: str, first: int, id_col: str = "doc_id", seed: int = 42):
    """The first rows, in shuffled order, of every batch of files."""

    def batch(rows: DataFrame, number: int) -> None:
        shuffled(rows, id_col, seed, first).write.mode("append").parquet(path)

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts(df: DataFrame, time: str, by: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows per window and group; late rows beyond the delay are dropped."""
    return df.withWatermark(time, delay).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))


def write(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Start writing all that is there, and stop."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
