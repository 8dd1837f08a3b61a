"""Crawl-index lookups, link expansion and the shapes of crawl metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import written


def seed_lookup(index: DataFrame, seeds: DataFrame) -> DataFrame:
    """Index rows under a seed: equal registered domain, and a key that starts with the seed's.

    The prefixes of a key that are as long as some seed of its domain meet the
    seeds by equality, so a domain with many rows and seeds doesn't pair them all.
    """
    s = seeds.select(F.col("id").alias("seed_id"), F.col("url_host_registered_domain").alias("__domain"), F.col("url_surtkey").alias("__key"))
    lengths = s.groupBy("__domain").agg(F.collect_set(F.length("__key")).alias("__lengths"))
    of = index.join(lengths, F.col("url_host_registered_domain") == F.col("__domain")).drop("__domain")
    fits = F.filter("__lengths", lambda n: n <= F.length("url_surtkey"))
    of = of.withColumn("__n", F.explode(fits)).withColumn("__prefix", F.expr("left(url_surtkey, __n)"))
    cond = (F.col("url_host_registered_domain") == F.col("__domain")) & (F.col("__prefix") == F.col("__key"))
    return of.join(s, cond).drop("__domain", "__key", "__lengths", "__n", "__prefix")


def next_lookup(index: DataFrame, urls: DataFrame) -> DataFrame:
    """Index rows of the given URLs."""
    return index.join(urls.select("url").distinct(), "url", "left_semi")


def latest(df: DataFrame, key: str = "url", time: str = "fetch_time", tie: str | None = None) -> DataFrame:
    """The newest record of each key; of equal times the one with the greatest tie column."""
    order = F.struct(time, tie) if tie else F.struct(time)
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def dense_ids(df: DataFrame, order: str, name: str = "id") -> DataFrame:
    """Row numbers from 0 without gaps, in the given order; nulls come first, ties go by a hash of the row.

    Rows are sorted by ranges, numbered within their range and written once; a
    row per range then says where its numbers start.
    """
    ties = F.xxhash64(*df.columns)
    at = monotonic_name(df)
    ranged = written(df.repartitionByRange(F.col(order), ties).sortWithinPartitions(F.col(order), ties).withColumn(at, F.monotonically_increasing_id()))
    part, place = F.shiftrightunsigned(at, 33), F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("__p")).agg(F.count("*").alias("__c"))
    start = counts.select("__p", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__s"))
    return ranged.join(F.broadcast(start), part == F.col("__p")).withColumn(name, F.col("__s") + place).drop("__p", "__s", at)


def monotonic_name(df: DataFrame) -> str:
    """A column name that df doesn't have."""
    have, name = {c.lower() for c in df.columns}, "__at"
    while name in have:
        name = "_" + name
    return name


def next_urls(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct external links of pages that aren't known yet."""
    return pages.select(F.explode("external_urls").alias("url")).distinct().join(known.select("url"), "url", "left_anti")


def expand(seeds: DataFrame, index: DataFrame, depth: int) -> DataFrame:
    """Pages reached from the seeds in up to ``depth`` steps of links, with the step as depth; each level is written, so none is made twice."""
    level = written(seeds.withColumn("depth", F.lit(0).cast("smallint")))
    found = level
    for d in range(1, depth + 1):
        level = written(next_lookup(index, next_urls(level, found)).withColumn("depth", F.lit(d).cast("smallint")))
        found = found.unionByName(level)
    return found


#: Links to one URL beyond which the URL counts as hot.
HOT = 50_000


def external_ids(pages: DataFrame, id_col: str = "id", url: str = "url", urls: str = "external_urls", time: str = "fetch_time", hot: int = HOT) -> DataFrame:
    """pages with external_ids: the newest row's id for each known external URL, in their order.

    URLs with more than ``hot`` links, known or not, are broadcast with their ids
    (at most a row per ``hot`` links), so that no task gets all links to one.
    """
    ids = pages.groupBy(F.col(url).alias("__url")).agg(F.max_by(F.col(id_col), F.struct(time, id_col)).alias("__id"))
    links = pages.select(F.col(id_col), F.posexplode(urls).alias("__pos", "__url")).where("__url IS NOT NULL")
    many = links.groupBy("__url").agg(F.count("*").alias("__n")).where(F.col("__n") > hot).select("__url")
    of_many = F.broadcast(many.join(ids, "__url", "left").select("__url", F.struct("__id").alias("__many")))
    marked = links.join(of_many, "__url", "left")
    few = marked.where("__many IS NULL").select(id_col, "__pos", "__url").join(ids, "__url").select(id_col, "__pos", "__id")
    found = few.unionByName(marked.where("__many IS NOT NULL").select(id_col, "__pos", F.col("__many.__id").alias("__id")).where("__id IS NOT NULL"))
    per = found.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__id"))), lambda x: x["__id"]).alias("external_ids"))
    return pages.join(per, id_col, "left").withColumn("external_ids", F.coalesce("external_ids", F.array().cast(per.schema["external_ids"].dataType)))


def depth_of(flavor: Column) -> Column:
    return F.when(flavor == "seed", 0).otherwise(F.regexp_extract(flavor, r"^intermediate_depth_(\d+)$", 1).cast("int"))


def pdf_url(url: Column, mime: Column) -> Column:
    return F.when(mime == "application/pdf", url)


def collapse(df: DataFrame, keep: list[str], extra: dict[str, Column] | None = None, into: str = "meta") -> DataFrame:
    """All columns but the kept ones, and extra ones, as one JSON string."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*rest, *[v.alias(k) for k, v in (extra or {}).items()])).alias(into))


def source_name(seed_id: Column) -> Column:
    return F.concat(F.lit("pseudo-crawl--"), seed_id.cast("string"))


def add_source(meta: Column, source: Column) -> Column:
    """JSON metadata with source_dataset set; null counts as no metadata."""
    old = F.coalesce(F.from_json(meta, "map<string,string>"), F.create_map().cast("map<string,string>"))
    return F.to_json(F.map_concat(F.map_filter(old, lambda k, _: k != "source_dataset"), F.create_map(F.lit("source_dataset"), source)))


def changed_rows(df: DataFrame) -> DataFrame:
    return df.where(~F.col("old_text").eqNullSafe(F.col("text")))


def exactly_one(table: DataFrame, key: str, value) -> DataFrame:
    """The row of a key; the query fails when there is not exactly one."""
    hits = table.where(F.col(key) == value)
    n = Window.partitionBy(F.lit(1))
    return hits.withColumn("__ok", F.assert_true(F.count("*").over(n) == 1)).where("__ok IS NULL").drop("__ok")


def normalize_language(lang: Column) -> Column:
    return F.when(lang.isin("zh-hans", "zh-cn", "zhs"), "zhs").when(lang.isin("zh-hant", "zh-tw", "zht"), "zht").otherwise(lang)
