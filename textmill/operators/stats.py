"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .crawl import dense_ids


def coverage(df: DataFrame, by: str, url: Column, size: Column, kind: Column) -> DataFrame:
    """Rows, distinct URLs, bytes and the counts of each kind as JSON, per group."""
    per = df.groupBy(by, kind.alias("__k")).agg(F.count("*").alias("n")).groupBy(by)
    hist = per.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__k", "n"))))).alias("histogram"))
    return df.groupBy(by).agg(F.count("*").alias("captures"), F.approx_count_distinct(url).alias("urls_estimate"), F.sum(size).alias("bytes")).join(hist, by)


def merge_histograms(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(key, n) summed over a column of JSON count maps, most first."""
    out = df.select(F.explode(F.from_json(column, "map<string,bigint>")).alias("key", "v")).groupBy("key").agg(F.sum("v").alias("n")).orderBy(F.desc("n"), "key")
    return out if top is None else out.limit(top)


def roll_up(df: DataFrame, key: str, length: int, value: str) -> DataFrame:
    """Sums of a value by the first characters of its key."""
    return df.groupBy(F.substring(key, 1, length).alias(key)).agg(F.sum(value).alias(value))


def lengths(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Mean and median bytes, and how many documents are empty."""
    n = F.octet_length(text)
    return df.groupBy(by).agg(F.count("*").alias("docs"), F.avg(n).alias("mean"), F.median(n).alias("median"), F.count_if(n == 0).alias("empty"))


def percentile_clip(df: DataFrame, column: str, q: float = 0.99) -> DataFrame:
    """Rows up to the interpolated percentile."""
    edge = df.agg(F.percentile(column, F.lit(q)).alias("__edge"))
    return df.crossJoin(F.broadcast(edge)).where(F.col(column) <= F.col("__edge")).drop("__edge")


def without_outliers(df: DataFrame, column: str, width: float = 9.0) -> DataFrame:
    """Rows nearer to the median than ``width`` median absolute deviations; all of them where the median is 0.  The medians are one row."""
    mid = df.agg(F.median(column).alias("__m"))
    off = F.abs(F.col(column) - F.col("__m"))
    both = df.crossJoin(F.broadcast(mid))
    mad = both.agg(F.median(off).alias("__d"))
    return both.crossJoin(F.broadcast(mad)).where((F.col("__m") == 0) | (off < width * F.col("__d"))).drop("__m", "__d")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) of all values: bins of [low, high], whose last has its upper edge; -1 and ``bins`` are those below and above, null those that are null."""
    at = F.least(F.floor((F.col(column) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return df.groupBy(F.when(F.col(column) < low, -1).when(F.col(column) > high, bins).otherwise(at).alias("bin")).agg(F.count("*").alias("n"))


def clipped_histogram(df: DataFrame, column: str, bins: int = 50, width: float = 9.0) -> DataFrame:
    """(bin, n) of equal bins from the least to the greatest value that is no outlier."""
    kept = without_outliers(df.select(F.col(column).cast("double").alias("v")), "v", width)
    edges = kept.agg(F.min("v").alias("__lo"), F.max("v").alias("__hi"))
    at = F.least(F.floor(F.coalesce(F.try_divide((F.col("v") - F.col("__lo")) * bins, F.col("__hi") - F.col("__lo")), F.lit(0.0))), F.lit(bins - 1)).cast("int")
    return kept.crossJoin(F.broadcast(edges)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def language_sizes(df: DataFrame) -> DataFrame:
    """Bytes, samples, bytes per sample and GB per language, largest first."""
    return df.groupBy("lang").agg(F.sum("size").alias("size"), F.sum("samples").alias("samples")).select("lang", "size", "samples", (F.col("size") / F.col("samples")).alias("per_sample"), (F.col("size") / 1e9).alias("gigabytes")).orderBy(F.desc("size"))


def splits_summary(splits: Column) -> dict[str, Column]:
    """Examples over all splits and the number of splits, of a map<name, struct<num_examples>>."""
    return {"samples": F.aggregate(F.map_values(splits), F.lit(0).cast("bigint"), lambda a, x: a + x["num_examples"]), "splits": F.cardinality(splits)}


def zipf(words: DataFrame) -> DataFrame:
    """(word, n, rank), most frequent first.

    Rows are numbered in their range of the order, so no window holds all words.
    """
    n = words.groupBy("word").agg(F.count("*").alias("n"))
    ranked = dense_ids(n.select(F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")).alias("o"), "word", "n"), "o", "rank")
    return ranked.select("word", "n", (F.col("rank") + 1).cast("int").alias("rank"))


def step_log(log: DataFrame) -> DataFrame:
    """One row per operation of a cleaning log: lines ``Applying: NAME`` and then ``KEY: NUMBER``, in the order of ``line_no``."""
    op = F.nullif(F.regexp_extract("line", r"Applying:? +(\S+)", 1), F.lit(""))
    at = Window.partitionBy("file").orderBy("line_no")
    named = log.withColumn("op", F.last(op, ignorenulls=True).over(at)).withColumn("step", F.count(op).over(at))
    pairs = named.select("file", "step", "op", F.lower(F.regexp_extract("line", r"(Initial|Final) number of samples: *\d+", 1)).alias("k"), F.regexp_extract("line", r"number of samples: *(\d+)", 1).alias("v")).where("k <> ''")
    wide = pairs.groupBy("file", "step", "op").pivot("k", ["initial", "final"]).agg(F.first(F.col("v").cast("bigint")))
    return wide.withColumn("removed_percent", F.round(100 * F.try_divide((F.col("initial") - F.col("final")).cast("double"), F.col("initial")), 6))


def error_classes(log: DataFrame, classes: dict[str, str]) -> DataFrame:
    """(kind, files): log files by the first class whose text they hold."""
    kind = F.lit("other")
    for name, part in reversed(classes.items()):
        kind = F.when(F.contains(F.col("content"), F.lit(part)), name).otherwise(kind)
    return log.groupBy(kind.alias("kind")).agg(F.count("*").alias("files"))
