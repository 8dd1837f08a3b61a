"""Shapes of metadata, names of datasets and languages, and what is summed by them."""

from __future__ import annotations

import ast
import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from . import crawl as K
from . import mixing as M

MAP = "map<string,string>"


def nested_url(meta: str = "meta", field: str = "warc-target-uri") -> Column:
    """A header of a web document's nested metadata."""
    return F.col(f"{meta}.headers")[field]


def url_and_line(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, url, text) of web documents, the text on one line."""
    return df.select(id_col, nested_url().alias("url"), F.translate("text", "\n", " ").alias("text"))


def _literal(text: str | None) -> dict[str, str | None] | None:
    if text is None:
        return None
    try:
        found = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None
    if not isinstance(found, dict):
        return None
    return {str(k): v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=str) for k, v in found.items()}


@F.pandas_udf(MapType(StringType(), StringType()))
def _literals(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for b in batches:
        yield b.map(_literal)


def parse_meta(meta: Column) -> Column:
    """Metadata as a map: JSON in the JVM, Python literals (None, single quotes) without evaluating anything; null for what is neither.

    Values that are no text are JSON.
    """
    return F.coalesce(F.try_variant_get(F.try_parse_json(meta), "$", MAP), _literals(meta))


def literal_meta(meta: Column) -> Column:
    """parse_meta for columns known to hold Python literals."""
    return _literals(meta)


def folded(df: DataFrame, source: Column, meta: str | None = "meta", keep: tuple[str, ...] = ("text",), default: dict[str, str] | None = None) -> DataFrame:
    """df with the kept columns and meta: what the metadata holds, all other columns and the source, as JSON.

    Columns win over keys of the same name, the source over both; a missing or
    unreadable metadata counts as ``default``.
    """
    none = F.create_map(*[F.lit(x) for kv in (default or {}).items() for x in kv]).cast(MAP)
    rest = [c for c in df.columns if c not in keep and c != meta]
    old = F.coalesce(_literals(F.col(meta)), none) if meta in df.columns else none
    more = F.create_map(*[x for c in rest for x in (F.lit(c), F.col(c).cast("string"))], F.lit("source_dataset"), source)
    names = [*rest, "source_dataset"]
    return df.select(*keep, F.to_json(F.map_concat(F.map_filter(old, lambda k, _: ~k.isin(names)), more)).alias("meta"))


def crawl_meta(url: Column, languages: Column, seed_id: Column) -> Column:
    return F.struct(url.alias("url"), languages.alias("content_languages"), seed_id.alias("seed_id"))


def code_meta(repo: Column, path: Column, licence: Column) -> Column:
    return F.to_json(F.struct(repo.alias("repo_name"), path.alias("path"), licence.alias("license")))


def language_of_path(path: Column) -> Column:
    """The language that a dataset's file name starts with: two letters, after a mark of its family."""
    return F.substring(F.regexp_replace(F.substring_index(path, "/", -1), "^(indic-|lm_)+", ""), 1, 2)


def dataset_parts(name: Column) -> Column:
    """struct(lang, name) of a dataset called lm_LANG_NAME or LANG_NAME; both Chinese scripts are zh, Niger-Congo ones nigercongo."""
    parts = F.split(F.regexp_replace(name, "^lm_", ""), "_")
    lang = F.when(F.startswith(parts[0], F.lit("zh")), "zh").when(F.startswith(parts[0], F.lit("nigercongo")), "nigercongo").otherwise(parts[0])
    return F.struct(lang.alias("lang"), F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "_").alias("name"))


def hub_name(path: Column) -> Column:
    """The last two parts of a path, as org/name; null where there are fewer."""
    return F.nullif(F.regexp_extract(path, r"([^/]+/[^/]+?)(?:/|\.jsonl(?:\.gz)?)?$", 1), F.lit(""))


def joined_columns(df: DataFrame, parts: list[str], lang: Column, source: str, split: str, text: str = "text") -> DataFrame:
    """(text, meta) of documents whose text is spread over columns: those that aren't null, joined by newlines."""
    return df.select(F.concat_ws("\n", *parts).alias(text), F.struct(lang.alias("langid"), F.lit(source).alias("source"), F.lit(split).alias("split")).alias("meta"))


def by_language_token(names: DataFrame, languages: list[str], name: str = "name") -> DataFrame:
    """(lang, n, names): names that have a language as one of their parts; names are few, as many as datasets."""
    parts = names.select(name, F.explode(F.array_distinct(F.split(F.regexp_replace(name, "^.*/", ""), "[-_]"))).alias("lang"))
    return parts.where(F.col("lang").isin(*languages)).groupBy("lang").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(name)), " ").alias("names"))


def crawl_selected(df: DataFrame, pattern: str, column: str = "crawl") -> DataFrame:
    """Rows of the crawls whose name starts with what the pattern matches, whatever its case."""
    return df.where(F.col(column).rlike(f"(?i)^(?:{pattern})"))


def with_label(df: DataFrame, label: str, labels: str = "labels") -> DataFrame:
    return df.where(F.coalesce(F.array_contains(labels, label), F.lit(False)))


def good_words(words: DataFrame, longest: int, bad_parts, column: str = "word") -> DataFrame:
    """Words up to a length that hold none of the parts."""
    w = F.col(column)
    return words.where(reduce(lambda c, b: c & ~F.contains(w, F.lit(b)), bad_parts, F.length(w) <= longest))


def table_metadata(df: DataFrame, name: str, text: str = "text") -> DataFrame:
    """One row: a dataset's rows, bytes of text and features."""
    features = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("num_examples"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("num_bytes"), F.lit(features).alias("features"))


def totals(df: DataFrame, captures: str, urls: str, size: str) -> DataFrame:
    """One row: captures per URL and GiB of all groups."""
    return df.agg(F.try_divide(F.sum(captures).cast("double"), F.sum(urls)).alias("captures_per_url"), (F.sum(size) / float(1 << 30)).alias("gib"))


def median_spread(df: DataFrame, by: str, value: Column) -> DataFrame:
    """(by, median, place, least, greatest): medians with their place from the greatest and the range of all of them; groups are few."""
    m = df.groupBy(by).agg(F.median(value).alias("median"))
    all_ = Window.partitionBy(F.lit(1))
    return m.select(by, "median", F.row_number().over(Window.orderBy(F.desc("median"), by)).alias("place"), F.min("median").over(all_).alias("least"), F.max("median").over(all_).alias("greatest"))


def cluster_lengths(members: DataFrame, lengths: DataFrame, cluster: str = "cluster", id_col: str = "doc_id", length: str = "len") -> DataFrame:
    """(cluster, docs, longest) of clusters of documents."""
    return members.join(lengths, id_col).groupBy(cluster).agg(F.count("*").alias("docs"), F.max(length).alias("longest"))


def duplicated_share(ranges: DataFrame, total: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row: bytes in the ranges, and their share of ``total`` (one row, one column of bytes)."""
    whole = total.columns[0]
    return ranges.agg(F.coalesce(F.sum(F.col(end) - F.col(start)), F.lit(0)).alias("bytes")).crossJoin(F.broadcast(total)).select("bytes", F.coalesce(F.try_divide(F.col("bytes").cast("double"), F.col(whole)), F.lit(0.0)).alias("share"))


def pair_lengths(pairs: DataFrame, lengths: DataFrame, a: str = "a", b: str = "b", id_col: str = "doc_id", length: str = "len") -> DataFrame:
    """pairs with length: of the two documents' lengths the greater."""
    one, two = (lengths.select(F.col(id_col).alias(x), F.col(length).alias(f"__{x}")) for x in (a, b))
    return pairs.join(one, a).join(two, b).withColumn("length", F.greatest(f"__{a}", f"__{b}")).drop(f"__{a}", f"__{b}")


def only_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.join(ids.select(id_col), id_col, "left_semi")


def size_estimate(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: bytes and mean bytes of the texts; exact, since a sum of lengths costs less here than a sample."""
    n = F.octet_length(text)
    return df.agg(F.coalesce(F.sum(n), F.lit(0)).alias("bytes"), F.avg(n).alias("mean"))


def value_counts(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def first_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the least order."""
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def html_and_others(df: DataFrame, mime: str = "mime") -> DataFrame:
    """One row: rows of HTML and of all other types."""
    html = F.coalesce(F.col(mime) == "text/html", F.lit(False))
    return df.agg(F.count_if(html).alias("html"), F.count_if(~html).alias("others"))


def level_ratios(sizes: DataFrame, target: float | Column, size: str = "size", by: list[str] | None = None) -> DataFrame:
    """sizes with ratio: the share of itself that each set gives when the target is filled evenly."""
    return M.water_level(sizes, target, size, by).withColumn("ratio", F.coalesce(F.try_divide(F.col("level"), F.col(size).cast("double")), F.lit(1.0)))


def capped_ratios(sizes: DataFrame, cap: float, extra: DataFrame | None = None, size: str = "size", by: str = "lang") -> DataFrame:
    """Ratios of the datasets of each language under its cap; ``extra`` datasets give all they have."""
    capped = M.capped(sizes, cap, size, by).withColumn("ratio", F.coalesce(F.try_divide(F.col("level"), F.col(size).cast("double")), F.lit(1.0)))
    return capped if extra is None else capped.unionByName(extra.withColumns({"level": F.col(size).cast("double"), "ratio": F.lit(1.0)}))


def deepest(splits: DataFrame, key: str, flavor: str = "flavor") -> DataFrame:
    """(key, flavor, depth): the deepest split of each seed."""
    d = K.depth_of(F.col(flavor))
    return splits.groupBy(key).agg(F.max_by(flavor, F.struct(d, flavor)).alias(flavor), F.max(d).alias("depth"))


def up_to_depth(splits: DataFrame, most: int, flavor: str = "flavor") -> DataFrame:
    """Splits to put together for a crawl up to a depth."""
    return splits.where(K.depth_of(F.col(flavor)) <= most)


def seed_lines(df: DataFrame, least_chars: int, text: str = "text") -> DataFrame:
    """Documents longer than ``least_chars`` characters."""
    return df.where(F.length(text) > least_chars)


def length_lists(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """(by, len, docs): how many documents have each length, which is what lists of lengths say and stays small."""
    return df.groupBy(by, F.octet_length(text).alias("len")).agg(F.count("*").alias("docs"))


def formatted(df: DataFrame, source: str, ratio: float, seed: int, id_col: str = "doc_id", meta: str | None = None, keep: tuple[str, ...] = ("text",)) -> DataFrame:
    """A dataset as the mixture takes it: a sample of its rows with the text and folded metadata.

    The seed is the mixture's plus the dataset's number, so samples are independent.
    """
    name = "__source"
    sample = M.sample_ratio(df.withColumn(name, F.lit(source)), F.lit(ratio), name, id_col, seed).drop(name)
    return folded(sample, F.lit(source), meta, keep)


def processes(asked: int, have: int) -> int:
    """How many tasks to run at once: -1 is all there are."""
    if asked == -1:
        return have
    if not 1 <= asked <= have:
        raise ValueError(f"{asked} processes, {have} are there")
    return asked


Preprocess = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


class Preprocessor:
    """What a plug-in that adds columns must have: their DDL, and a function over batches."""

    columns: str = ""

    def preprocess(self, batch: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError


def preprocessed(df: DataFrame, plug_in: Preprocessor) -> DataFrame:
    """df with the columns of a plug-in, which sees it batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield plug_in.preprocess(b)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{ddl}, {plug_in.columns}")
