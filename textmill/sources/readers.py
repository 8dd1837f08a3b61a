"""Readers; schemas are declared, paths may be of any file system that Spark knows."""

from __future__ import annotations

import gzip
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.crawl import dense_ids

CRAWL_SCHEMA = """
HtmlPreprocessor_error BIGINT, HtmlPreprocessor_error_comment STRING, content_languages STRING, content_mime_detected STRING,
depth SMALLINT, download_exception STRING, external_urls ARRAY<STRING>, fetch_redirect STRING, fetch_status INT, fetch_time TIMESTAMP,
html_error STRING, html_footer ARRAY<STRING>, html_head ARRAY<STRING>, html_str STRING, html_title ARRAY<STRING>,
metadata_html ARRAY<STRUCT<char_end_idx: BIGINT, char_start_idx: BIGINT, html_attrs: STRUCT<attrs: ARRAY<STRING>, `values`: ARRAY<STRING>>,
key: STRING, relative_end_pos: BIGINT, relative_start_pos: BIGINT, type: STRING, value: STRING>>,
seed_id INT, text STRING, url STRING, url_host_name STRING, url_host_registered_domain STRING, url_host_tld STRING, url_surtkey STRING,
warc_filename STRING, warc_record_length INT, warc_record_offset INT
"""
SIZES_SCHEMA = "name STRING, size BIGINT, samples BIGINT, splits INT, lang STRING"
RATIOS_SCHEMA = "dataset_path STRING, is_catalogue BOOLEAN, ratio DOUBLE"


def dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A Parquet dataset, or one split of it (a ``split`` column or partition)."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def json_lines(spark: SparkSession, path: str | list[str], schema: str = CRAWL_SCHEMA, recursive: bool = False, pattern: str | None = None) -> DataFrame:
    """JSON lines, gzipped or not, with a declared schema."""
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)


def crawl_index(spark: SparkSession, path: str, subset: str = "warc", columns: list[str] | None = None, rows: tuple[int, int] | None = None, order: str = "url_surtkey") -> DataFrame:
    """One partition of a crawl index; the filter and the columns reach the scan.  ``rows`` are the first and the row after the last, in the order."""
    df = spark.read.parquet(path).where(F.col("subset") == subset)
    df = row_range(df, order, *rows) if rows else df
    return df.select(*columns) if columns else df


def row_range(df: DataFrame, order: str, first: int, end: int) -> DataFrame:
    """Rows number first to end - 1 in the order, from 0."""
    return dense_ids(df, order, "__row").where(F.col("__row").between(first, end - 1)).drop("__row")


def csv_table(spark: SparkSession, path: str | list[str], schema: str = SIZES_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def listed(spark: SparkSession, paths: list[str], schema: str, column: str) -> DataFrame:
    """(row, value): a column of several CSV files with headers, numbered file by file in the order given and line by line; the lists are small."""
    files = spark.createDataFrame([(p.rsplit("/", 1)[-1], i) for i, p in enumerate(paths)], "__name string, __file int")
    rows = csv_table(spark, paths, schema).select(F.col(column).alias("value"), F.col("_metadata.file_name").alias("__name"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__line"))
    at = rows.join(F.broadcast(files), "__name").select(F.struct("__file", "__at", "__line").alias("o"), "value")
    return dense_ids(at, "o", "row").select("row", "value")


def ratios(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATIOS_SCHEMA).option("multiLine", True).json(path)


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of seeds, with the homepage lifted to ``link``."""
    return spark.read.option("multiLine", True).json(path).withColumn("link", F.col("description.homepage"))


def paired_lines(spark: SparkSession, names: str, values: str, schema: str) -> DataFrame:
    """(name, value, bad) of two text files line by line; empty lines are skipped, bad JSON is marked.

    Lines are numbered in their part of the file and the parts in theirs, so no task reads a whole file.
    """

    def numbered(path: str, name: str) -> DataFrame:
        lines = spark.read.text(path).where(F.trim("value") != "").select(F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("l")).alias("o"), F.col("value").alias(name))
        return dense_ids(lines, "o", "n").select("n", name)

    both = numbered(names, "name").join(numbered(values, "raw"), "n")
    value = F.from_json("raw", schema, {"mode": "PERMISSIVE"})
    return both.select("name", value.alias("value"), F.expr("try_parse_json(raw) IS NULL").alias("bad"))


def external_table(spark: SparkSession, name: str, path: str) -> None:
    """A table over Parquet files, its partitions found."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")


def partitioned_table(spark: SparkSession, name: str, path: str, schema: str, by: list[str]) -> None:
    """A table over Parquet folders by the named columns, which the schema has as well; its partitions are found."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'")
    recover_partitions(spark, name)


def recover_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def language_of_path(df: DataFrame) -> DataFrame:
    """df with lang, from folders called lm_LANG_NAME."""
    return df.withColumn("lang", F.regexp_extract("_metadata.file_path", r"/lm_([a-z]+)_", 1))


def shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths)


def seed_shard(spark: SparkSession, root: str, seed_id: int) -> DataFrame:
    return spark.read.parquet(root).where(F.col("seed_id") == seed_id)


def one_seed(df: DataFrame, seed_id: int) -> DataFrame:
    """df; the query fails on a row of another seed."""
    return df.where(F.assert_true(F.coalesce(F.col("seed_id") == seed_id, F.lit(False)), F.lit(f"not all rows are of seed {seed_id}")).isNull())


def latest_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(order).limit(n)


Fetch = Callable[[str, int, int], bytes]


def local_fetch(name: str, offset: int, length: int) -> bytes:
    with open(name, "rb") as f:
        f.seek(offset)
        return f.read(length)


def fetch_records(df: DataFrame, fetch: Fetch = local_fetch, threads: int = 16) -> DataFrame:
    """df with compressed_warc and download_exception; rows that have their bytes are left as they are."""
    have = "compressed_warc" in df.columns
    names = [c for c in df.columns if c not in ("compressed_warc", "download_exception")]

    def one(row) -> tuple[bytes | None, str | None]:
        old = row.get("compressed_warc")
        if old is not None and not isinstance(old, float):
            return bytes(old), None
        try:
            return fetch(row["warc_filename"], int(row["warc_record_offset"]), int(row["warc_record_length"])), None
        except Exception as e:  # noqa: BLE001 - the error is the row's result
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                got = list(pool.map(one, b.to_dict("records")))
                out = b[names].copy()
                out["compressed_warc"], out["download_exception"] = [g[0] for g in got], [g[1] for g in got]
                yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in names)
    return df.select(*names, *(["compressed_warc"] if have else [])).mapInPandas(run, f"{schema}, compressed_warc binary, download_exception string")


def failed(df: DataFrame) -> DataFrame:
    return df.where("download_exception IS NOT NULL")


def refetch(df: DataFrame, fetch: Fetch = local_fetch) -> DataFrame:
    """Fetch again where the bytes are missing."""
    return df.where("compressed_warc IS NOT NULL").unionByName(fetch_records(df.where("compressed_warc IS NULL"), fetch))


def warc_body(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of the HTTP response in a gzipped WARC record."""
    raw = gzip.decompress(record)
    head, _, rest = raw.partition(b"\r\n\r\n")
    if b"WARC-Type: response" not in head:
        raise ValueError("not a response record")
    http, _, body = rest.partition(b"\r\n\r\n")
    lines = http.decode("latin-1").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, body


def _declared(body: bytes) -> str:
    """The character set that a byte order mark or the head of a page declares; UTF-8 where that reads it, else Latin-1."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if body.startswith(mark):
            return name
    found = re.search(rb"(?i)<meta[^>]+charset\s*=\s*[\"']?([a-z0-9_:.-]+)", body[:4096])
    if found:
        return found[1].decode("ascii")
    try:
        body.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        return "latin-1"


def html_of(record: bytes | None, mime: str | None) -> tuple[str | None, str | None]:
    """(html, error) of a record; only text/html is decoded."""
    if record is None or mime != "text/html":
        return None, None
    try:
        headers, body = warc_body(record)
        kind = headers.get("content-type", "")
        charset = kind.partition("charset=")[2].partition(";")[0].strip("\"' ") or _declared(body)
        return body.decode(charset, "replace"), None
    except Exception as e:  # noqa: BLE001 - the error is the row's result
        return None, f"{type(e).__name__}: {e}"


@F.pandas_udf(StructType([StructField("html", StringType()), StructField("error", StringType())]))
def _html(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for records, mimes in batches:
        yield pd.DataFrame([html_of(None if r is None else bytes(r), m) for r, m in zip(records, mimes)], columns=["html", "error"])


def with_html(df: DataFrame, record: str = "compressed_warc", mime: str = "content_mime_detected") -> DataFrame:
    """df with html_str and html_error of the fetched records."""
    out = df.withColumn("__html", _html.asNondeterministic()(F.col(record), F.col(mime)))
    return out.withColumn("html_str", F.col("__html.html")).withColumn("html_error", F.col("__html.error")).drop("__html")


def numbered_rows(df: DataFrame, order: str) -> DataFrame:
    return dense_ids(df, order, "row")
