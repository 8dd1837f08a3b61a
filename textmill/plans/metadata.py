"""Queries over metadata, names of datasets, clusters and mixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import cleaning as C
from ..operators import metadata as X
from ..operators import quality as Q
from ..registry import query
from .crawl import _PATH
from .documents import WORDS


@query("SELECT page_id AS id, url, replace(html, chr(10), ' ') AS text FROM pages")
def prj_nested_url(t):
    headers = F.create_map(F.lit("warc-target-uri"), F.col("url"), F.lit("warc-type"), F.lit("response"))
    return X.url_and_line(t.pages.select(F.col("page_id").alias("id"), F.col("html").alias("text"), F.struct(headers.alias("headers")).alias("meta")))


def _literal():
    """A Python literal such as old metadata is."""
    return F.concat(F.lit("{'id': "), F.col("doc_id").cast("string"), F.lit(", 'title': None, 'source': '"), F.col("source"), F.lit("', 'tags': ['a', True]}"))


@query("SELECT doc_id, doc_id::VARCHAR AS id, NULL::VARCHAR AS title, source, '[\"a\", true]' AS tags FROM documents")
def prj_parse_meta(t):
    m = t.documents.select("doc_id", X.literal_meta(_literal()).alias("m"))
    return m.select("doc_id", *[F.col("m")[k].alias(k) for k in ("id", "title", "source", "tags")])


@query("SELECT doc_id, lang, doc_id::VARCHAR AS id, 'set-' || source AS source_dataset, 'x' AS licence FROM documents")
def prj_fold_columns(t):
    docs = t.documents.select("doc_id", "lang", "source", F.lit("x").alias("licence"), _literal().alias("meta"))
    out = X.folded(docs, F.concat(F.lit("set-"), F.col("source")), keep=("doc_id",))
    return out.select("doc_id", *[F.get_json_object("meta", f"$.{k}").alias(k) for k in ("lang", "id", "source_dataset", "licence")])


@query("SELECT page_id, url, 'en' AS content_languages, page_id % 10 AS seed_id FROM pages")
def prj_crawl_meta(t):
    return t.pages.select("page_id", X.crawl_meta(F.col("url"), F.lit("en"), F.col("page_id") % 10).alias("m")).select("page_id", "m.*")


@query("SELECT p_partkey, '{\"repo_name\":\"' || p_brand || '\",\"path\":\"' || p_name || '\",\"license\":\"mit\"}' AS meta FROM part")
def prj_code_meta(t):
    return t.part.select("p_partkey", X.code_meta(F.col("p_brand"), F.col("p_name"), F.lit("mit")).alias("meta"))


@query("SELECT doc_id, lang AS file_lang FROM documents")
def prj_language_of_path(t):
    path = F.concat(F.lit("/data/"), F.when(F.col("doc_id") % 2 == 0, "lm_").otherwise("indic-"), "lang", F.lit("_"), "source", F.lit(".jsonl"))
    return t.documents.select("doc_id", X.language_of_path(path).alias("file_lang"))


@query("SELECT page_id, array_to_string(list_filter(string_split(html, chr(10)), lambda x: NOT contains(x, '<') AND NOT contains(x, '>')), chr(10)) AS text FROM pages")
def map_remove_lines_with_tags(t):
    return t.pages.select("page_id", C.drop_lines_with(F.col("html"), ("<", ">")).alias("text"))


@query("SELECT DISTINCT CASE WHEN lang = 'de' THEN 'zh' ELSE lang END AS lang, source || '_x' AS name FROM documents")
def map_dataset_parts(t):
    name = F.concat(F.lit("lm_"), F.when(F.col("lang") == "de", "zh-cn").otherwise(F.col("lang")), F.lit("_"), "source", F.lit("_x"))
    return t.documents.select(X.dataset_parts(name).alias("p")).distinct().select("p.*")


@query("SELECT DISTINCT lang || '/' || source AS name FROM documents")
def map_hub_name(t):
    path = F.concat(F.lit("/a/b/"), "lang", F.lit("/"), "source", F.when(F.col("doc_id") % 2 == 0, ".jsonl.gz").otherwise("/"))
    return t.documents.select(X.hub_name(path).alias("name")).distinct()


@query("SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE role || chr(10) || text END AS text, role AS langid, 'chats' AS source, 'train' AS split FROM conversations")
def map_joined_columns(t):
    key = F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    d = t.conversations.select(F.when(F.col("role") != "user", F.col("role")).alias("title"), F.col("text").alias("content"), "role", key.alias("key"))
    # The key goes through as the language, so that rows can be told apart.
    out = X.joined_columns(d, ["title", "content"], F.concat_ws("|", "key", "role"), "chats", "train")
    k = F.split("meta.langid", r"\|")
    return out.select(k[0].cast("bigint").alias("conv_id"), k[1].cast("int").alias("turn"), "text", k[2].alias("langid"), "meta.source", "meta.split")


@query("SELECT lang, count(*)::BIGINT AS n, string_agg(name, ' ' ORDER BY name) AS names FROM (SELECT DISTINCT lang, 'org/ds-' || lang || '-' || source AS name FROM documents) WHERE lang IN ('en', 'fr') GROUP BY lang")
def map_repos_by_language(t):
    return X.by_language_token(t.documents.select(F.concat_ws("-", F.lit("org/ds"), "lang", "source").alias("name")).distinct(), ["en", "fr"])


@query("SELECT doc_id FROM documents WHERE starts_with(lower(source), 'src1')")
def flt_crawl_selector(t):
    return X.crawl_selected(t.documents.withColumnRenamed("source", "crawl"), "SRC1").select("doc_id")


@query("SELECT doc_id FROM labels WHERE toxic = 1")
def flt_label(t):
    labels = F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")))
    return X.with_label(t.labels.select("doc_id", labels.alias("labels")), "toxic").select("doc_id")


@query(f"SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest({WORDS}) AS word FROM documents) WHERE length(word) <= 12 AND NOT contains(word, 'http') AND NOT contains(word, 'www') AND NOT contains(word, '.com') AND NOT contains(word, 'href') AND NOT contains(word, '//') GROUP BY word")
def flt_words(t):
    from ..functions import text as T

    words = t.documents.select(F.explode(T.words(F.col("text"))).alias("word"))
    return X.value_counts(X.good_words(words, 12, Q.BAD_PARTS), F.col("word"), "word")


@query("SELECT doc_id FROM documents WHERE length(text) > 500")
def ddp_seed_lines(t):
    return X.seed_lines(t.documents, 500).select("doc_id")


@query("SELECT 'documents' AS name, count(*)::BIGINT AS num_examples, sum(octet_length(encode(text)))::BIGINT AS num_bytes FROM documents")
def agg_table_metadata(t):
    return X.table_metadata(t.documents, "documents").drop("features")


@query("SELECT round(count(*)::DOUBLE / count(DISTINCT user_id), 6) AS captures_per_url, round(sum(user_id) / 1073741824.0::DOUBLE, 9) AS gib FROM events")
def agg_totals(t):
    per = t.events.groupBy("user_id").agg(F.count("*").alias("captures"), F.lit(1).alias("urls"), F.sum("user_id").alias("bytes"))
    return X.totals(per, "captures", "urls", "bytes").select(F.round("captures_per_url", 6).alias("captures_per_url"), F.round("gib", 9).alias("gib"))


@query("SELECT lang, median, row_number() OVER (ORDER BY median DESC, lang)::INT AS place, min(median) OVER () AS least, max(median) OVER () AS greatest FROM (SELECT lang, median(octet_length(encode(text)))::DOUBLE AS median FROM documents GROUP BY lang)")
def agg_median_spread(t):
    return X.median_spread(t.documents, "lang", F.octet_length("text"))


_CLUSTERS = "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS cluster, octet_length(encode(text)) AS len FROM documents"


def _clusters(t):
    least = t.documents.groupBy("text").agg(F.min("doc_id").alias("cluster"))
    return t.documents.join(least, "text").select("doc_id", "cluster")


def _lengths(t):
    return t.documents.select("doc_id", F.octet_length("text").alias("len"))


@query(f"SELECT cluster, count(*)::BIGINT AS docs, max(len)::INT AS longest FROM ({_CLUSTERS}) GROUP BY cluster")
def agg_cluster_longest(t):
    return X.cluster_lengths(_clusters(t), _lengths(t))


@query(f"SELECT sum(CASE WHEN doc_id <> cluster THEN len ELSE 0 END)::BIGINT AS bytes, round(sum(CASE WHEN doc_id <> cluster THEN len ELSE 0 END)::DOUBLE / sum(len), 9) AS share FROM ({_CLUSTERS})")
def agg_duplicated_share(t):
    ranges = _clusters(t).where("doc_id <> cluster").join(_lengths(t), "doc_id").select(F.lit(0).alias("start"), F.col("len").alias("end"))
    total = t.documents.agg(F.sum(F.octet_length("text")).alias("total"))
    return X.duplicated_share(ranges, total).select(F.col("bytes").cast("bigint").alias("bytes"), F.round("share", 9).alias("share"))


@query(f"SELECT doc_id AS a, cluster AS b, greatest(len, (SELECT max(octet_length(encode(text))) FROM documents d WHERE d.doc_id = c.cluster))::INT AS length FROM ({_CLUSTERS}) c WHERE doc_id <> cluster")
def joi_pair_lengths(t):
    return X.pair_lengths(_clusters(t).where("doc_id <> cluster").select(F.col("doc_id").alias("a"), F.col("cluster").alias("b")), _lengths(t))


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def joi_only_ids(t):
    return X.only_ids(t.documents, t.labels.where("quality = 1")).select("doc_id", "lang")


@query("SELECT sum(octet_length(encode(text)))::BIGINT AS bytes, round(avg(octet_length(encode(text))), 6) AS mean FROM documents")
def agg_size_estimate(t):
    return X.size_estimate(t.documents).withColumn("mean", F.round("mean", 6))


@query(rf"SELECT left(coalesce(nullif(regexp_replace({_PATH.format('url')}, '[^/]*\.[^/]*$', ''), ''), '/'), 16) AS value, count(*)::BIGINT AS n FROM pages GROUP BY ALL")
def agg_path_prefixes(t):
    return X.value_counts(t.pages, U.path_prefix(F.col("url")))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def agg_first_by_key(t):
    return X.first_by_key(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT count(*) FILTER (starts_with(lower(html), '<!doctype'))::BIGINT AS html, count(*) FILTER (NOT starts_with(lower(html), '<!doctype'))::BIGINT AS others FROM pages")
def agg_html_and_others(t):
    mime = F.when(F.startswith(F.lower("html"), F.lit("<!doctype")), "text/html")
    return X.html_and_others(t.pages.select(mime.alias("mime")))


_SIZES = "SELECT source, sum(octet_length(encode(text)))::DOUBLE AS size FROM documents GROUP BY source"


def _sizes(t, *by):
    return t.documents.groupBy(*(by or ["source"])).agg(F.sum(F.octet_length("text")).cast("double").alias("size"))


@query(f"""WITH s AS ({_SIZES}), o AS (SELECT *, (1000000 - coalesce(sum(size) OVER (ORDER BY size, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (count(*) OVER () - row_number() OVER (ORDER BY size, source) + 1) AS even FROM s)
SELECT source, round(least(coalesce((SELECT min(even) FROM o WHERE even <= size), (SELECT max(size) FROM o)), size) / size, 9) AS ratio FROM o""")
def smp_level_ratios(t):
    return X.level_ratios(_sizes(t), 1_000_000).select("source", F.round("ratio", 9).alias("ratio"))


@query("""WITH s AS (SELECT lang, source, sum(octet_length(encode(text)))::DOUBLE AS size FROM documents GROUP BY ALL), o AS (SELECT *, (least(200000, sum(size) OVER (PARTITION BY lang)) - coalesce(sum(size) OVER (PARTITION BY lang ORDER BY size, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (count(*) OVER (PARTITION BY lang) - row_number() OVER (PARTITION BY lang ORDER BY size, source) + 1) AS even FROM s),
l AS (SELECT lang, source, least(coalesce(min(CASE WHEN even <= size THEN even END) OVER (PARTITION BY lang), max(size) OVER (PARTITION BY lang)), size) / size AS ratio FROM o)
SELECT lang, source, round(ratio, 9) AS ratio FROM l UNION ALL SELECT 'extra', 'all', 1.0""")
def smp_capped_ratios(t):
    extra = t.spark.range(1).select(F.lit("extra").alias("lang"), F.lit("all").alias("source"), F.lit(5.0).alias("size"))
    return X.capped_ratios(_sizes(t, "lang", "source"), 200_000, extra).select("lang", "source", F.round("ratio", 9).alias("ratio"))


_FLAVOR = "CASE WHEN event_type = 'click' THEN 'seed' ELSE 'intermediate_depth_' || (event_id % 4) END"


def _flavored(t):
    return t.events.select("user_id", F.when(F.col("event_type") == "click", "seed").otherwise(F.concat(F.lit("intermediate_depth_"), F.col("event_id") % 4)).alias("flavor"))


@query(f"SELECT user_id, max_by(flavor, depth * 10 + CASE WHEN flavor = 'seed' THEN 1 ELSE 0 END) AS flavor, max(depth)::INT AS depth FROM (SELECT user_id, {_FLAVOR} AS flavor, CASE WHEN event_type = 'click' THEN 0 ELSE event_id % 4 END AS depth FROM events) GROUP BY user_id")
def smp_deepest(t):
    return X.deepest(_flavored(t), "user_id")


@query("SELECT user_id, count(*)::BIGINT AS n FROM events WHERE event_type = 'click' OR event_id % 4 <= 2 GROUP BY user_id")
def src_up_to_depth(t):
    return X.up_to_depth(_flavored(t), 2).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT lang, octet_length(encode(text))::INT AS len, count(*)::BIGINT AS docs FROM documents GROUP BY ALL")
def snk_length_lists(t):
    return X.length_lists(t.documents, "lang")


@query("SELECT doc_id, 'mix' AS source_dataset, lang FROM (SELECT *, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || '|45'), doc_id) AS k, count(*) OVER () AS n FROM documents) WHERE k <= floor(n * 0.5)")
def prj_formatted(t):
    out = X.formatted(t.documents.select("doc_id", "text", "lang"), "mix", 0.5, 42 + 3, keep=("doc_id", "text"))
    return out.select("doc_id", F.get_json_object("meta", "$.source_dataset").alias("source_dataset"), F.get_json_object("meta", "$.lang").alias("lang"))
