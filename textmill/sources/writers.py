"""Sinks; all of them write through Spark's commit protocol, so readers see whole results or none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import written
from ..operators.cleaning import changes
from ..operators.crawl import dense_ids
from ..operators.dedup import multiplicities
from ..operators.metadata import length_lists
from ..operators.mixing import contiguous


def save(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def json_lines(df: DataFrame, path: str, shards: int | None = None, gzip: bool = False, overwrite: bool = False) -> None:
    """JSON lines, in a number of shards of about equal rows if one is given."""
    out = df if shards is None else df.repartition(shards)
    writer = out.write.mode("overwrite" if overwrite else "errorifexists")
    (writer.option("compression", "gzip") if gzip else writer).json(path)


def contiguous_shards(df: DataFrame, path: str, order: str, most_bytes: int, text: str = "text") -> int:
    """Gzipped JSON lines in ranges of the order column, as many as the text's bytes need; returns the number.

    Rows are numbered, and shard i has rows i n / shards to (i + 1) n / shards, so
    shards differ by a row at most; their bytes are about equal, not bounded.
    """
    total, rows = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    n = max(1, min(-(-total // most_bytes), rows))
    numbered_shards(dense_ids(df, order, "__row").withColumn("shard", contiguous(F.col("__row"), F.lit(rows), n)).drop("__row"), path, n)
    return n


def round_robin_shards(df: DataFrame, path: str, order: str, shards: int = 8) -> None:
    """Row i of the order in shard i modulo their number, as JSON lines."""
    numbered_shards(dense_ids(df, order, "__row").withColumn("shard", F.pmod("__row", F.lit(shards))).drop("__row"), path, shards, gzip=False)


def numbered_shards(df: DataFrame, path: str, shards: int, gzip: bool = True) -> None:
    """A folder shard=00-of-08 and so on for each value of the column shard, written only where it isn't there yet."""
    digits = len(str(max(shards - 1, 1)))
    name = F.concat(F.lpad(F.col("shard").cast("string"), max(digits, 2), "0"), F.lit(f"-of-{shards:02d}"))
    out = df.withColumn("shard", name).repartition(shards, "shard").write.mode("ignore").partitionBy("shard")
    (out.option("compression", "gzip") if gzip else out).json(path)


def by_mime(df: DataFrame, html_path: str, other_path: str) -> None:
    """Pages as gzipped JSON lines without their raw bytes, everything else as Parquet."""
    page = F.coalesce(F.col("content_mime_detected") == "text/html", F.lit(False))
    df.where(page).drop("compressed_warc").write.option("compression", "gzip").json(html_path)
    df.where(~page).write.parquet(other_path)


def partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """One folder per value, in one pass."""
    df.write.mode("errorifexists").partitionBy(*columns).parquet(path)


def csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    df.write.mode("errorifexists").option("header", header).option("sep", sep).csv(path)


def matches_and_clusters(pairs: DataFrame, clusters: DataFrame, path: str) -> None:
    """Near-duplicate pairs and clusters as tab-separated files."""
    csv(pairs, f"{path}/matches.tsv", sep="\t")
    csv(clusters, f"{path}/clusters.tsv", sep="\t")


def aligned_columns(df: DataFrame, path: str, id_col: str, text_col: str) -> None:
    """Two headerless one-column files in the same order of rows: both are cut from one table of numbered rows."""
    rows = dense_ids(df.select(id_col, text_col), id_col, "__row")
    rows = written(rows.repartitionByRange("__row").sortWithinPartitions("__row"))
    for name in (id_col, text_col):
        csv(rows.orderBy("__row").select(name), f"{path}/{name}.csv", header=False)


def checked_step(before: DataFrame, after: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The rows that a step changed or removed, for people to check."""
    save(changes(before, after, id_col), path)


def duplicate_report(df: DataFrame, path: str) -> None:
    """Texts that occur more than once, as JSON lines."""
    json_lines(multiplicities(df), path)


def examples(pairs: DataFrame, docs: DataFrame, path: str, rows: int = 1000, id_col: str = "doc_id") -> None:
    """A sample of matching pairs with both texts."""
    one, two = (docs.select(F.col(id_col).alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b"))
    sample = pairs.orderBy(F.xxhash64("a", "b"), "a", "b").limit(rows)
    save(sample.join(one, "a").join(two, "b"), path)


def lengths(df: DataFrame, path: str, by: str = "lang") -> None:
    """How many documents of each group have each length."""
    partitioned(length_lists(df, by), path, by)


def compressed_table(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "gzip").parquet(path)


def good_and_failed(df: DataFrame, good_path: str, failed_path: str) -> None:
    """Fetched rows, and those whose fetch failed; fetched once."""
    rows = written(df)
    rows.where("download_exception IS NULL").write.parquet(good_path)
    rows.where("download_exception IS NOT NULL").write.parquet(failed_path)


def fetch_report(df: DataFrame) -> DataFrame:
    """One row: rows, and those whose fetch failed."""
    return df.agg(F.count("*").alias("rows"), F.count("download_exception").alias("failed"))
