"""Queries over pages, events and the relational tables: crawl lookups, metadata shapes, joins and windows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import urls as U
from ..operators import cleaning as C
from ..operators import crawl as K
from ..operators import dedup as D
from ..operators import html as H
from ..operators import mixing as M
from ..operators import stats as S
from ..registry import query

_HOST = r"nullif(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', ''), '')"
_PATH = r"coalesce(nullif(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), ''), '/')"
_SURT = f"array_to_string(list_reverse(string_split(regexp_replace({_HOST}, '^www\\.', ''), '.')), ',') || ')' || lower({_PATH.format('url')})"
_KEYED = f"(SELECT *, {U.sql_suffix('h')[1]} AS d FROM (SELECT *, {_HOST} AS h FROM pages))"
_LINKS = "list_distinct(regexp_extract_all(html, '(?i)<a\\s[^>]*\\bhref\\s*=\\s*[\"'']([^\"''>]*)[\"'']', 1))"


@query(f"SELECT page_id, h AS host, d AS domain, {U.sql_suffix('h')[0]} AS suffix, {_SURT} AS surt FROM {_KEYED}")
def map_url_keys(t):
    return t.pages.select("page_id", U.host(F.col("url")).alias("host"), U.registered_domain(F.col("url")).alias("domain"), U.public_suffix(U.host(F.col("url"))).alias("suffix"), U.surt(F.col("url")).alias("surt"))


@query(rf"SELECT page_id, left(coalesce(nullif(regexp_replace({_PATH.format('url')}, '[^/]*\.[^/]*$', ''), ''), '/'), 16) AS prefix FROM pages")
def map_path_prefix(t):
    return t.pages.select("page_id", U.path_prefix(F.col("url")).alias("prefix"))


@query("SELECT page_id, regexp_extract(html, '(?i)<html[^>]*\\blang\\s*=\\s*[\"'']?([A-Za-z0-9-]+)', 1) AS lang, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages")
def map_html_lang_title(t):
    return t.pages.select("page_id", H.html_lang(F.col("html")).alias("lang"), H.title(F.col("html")).alias("title"))


@query(f"SELECT page_id, link FROM (SELECT page_id, unnest({_LINKS}) AS link FROM pages)")
def map_links(t):
    return t.pages.select("page_id", F.explode(H.links(F.col("html"))).alias("link"))


@query(f"SELECT page_id, array_to_string(list_sort(list_filter({_LINKS}, lambda x: regexp_matches(x, '^(?i)https?://') AND NOT contains(x, d))), ' ') AS external FROM {_KEYED}")
def map_external_links(t):
    return t.pages.select("page_id", F.array_join(F.sort_array(H.external_links(F.col("html"), U.registered_domain(F.col("url")))), " ").alias("external"))


@query()
def map_html_text(t):
    return H.with_text(t.pages).select("page_id", "text", "html_title", "html_error", F.size("metadata_html").alias("tags"))


_META = "SELECT page_id, url FROM pages"


@query("SELECT page_id, CASE WHEN row_number() OVER (PARTITION BY regexp_extract(url, '^(.[^?]*)', 1) ORDER BY page_id) = 1 THEN url ELSE '' END AS text FROM pages")
def ddp_url(t):
    docs = t.pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("text"), F.to_json(F.struct("url")).alias("meta"))
    return C.apply("dedup_document_on_url", docs).select(F.col("doc_id").alias("page_id"), "text")


@query("SELECT page_id FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1")
def ddp_strict_url(t):
    return D.drop_copies(t.pages.select("page_id", "url"), D.strict_url_key(F.col("url")), "page_id").select("page_id")


@query("SELECT page_id, md5(regexp_extract(url, '^(.*?)(?:/amp(?:$|[/?#])|\\?|$)', 1)) AS key FROM pages")
def ddp_amp_key(t):
    return t.pages.select("page_id", D.amp_key(F.col("url")).alias("key"))


_PARTS = "list_transform(list_filter(string_split(q, '&'), lambda p: regexp_matches(p, '^(id|news-id)=')), lambda p: 'id=' || regexp_replace(p, '^[^=]*=', ''))"


@query(f"SELECT page_id, md5(b || CASE WHEN len({_PARTS}) > 0 THEN '?' || array_to_string({_PARTS}, '&') ELSE '' END) AS key FROM (SELECT page_id, regexp_extract(regexp_replace(url, '#.*$', ''), '^(.[^?]*)', 1) AS b, regexp_extract(replace(url, 'page=', 'news-id='), '[?]([^#]*)', 1) AS q FROM pages)")
def ddp_parameter_key(t):
    return t.pages.select("page_id", D.id_parameter_key(F.replace("url", F.lit("page="), F.lit("news-id="))).alias("key"))


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def win_latest_per_key(t):
    return K.latest(t.events, "user_id", "ts", "event_id").select("event_id", "user_id", "event_type")


@query(f"WITH i AS (SELECT page_id, d, {_SURT} AS k FROM {_KEYED}), s AS (SELECT min(page_id) AS seed_id, d AS sd, regexp_extract(k, '^([^)]*)', 1) AS sk FROM i WHERE k IS NOT NULL GROUP BY ALL) SELECT page_id, seed_id FROM i JOIN s ON d = sd AND starts_with(k, sk)")
def joi_seed_prefix(t):
    index = t.pages.select("page_id", U.registered_domain(F.col("url")).alias("url_host_registered_domain"), U.surt(F.col("url")).alias("url_surtkey"))
    hosts = index.where("url_surtkey IS NOT NULL").groupBy("url_host_registered_domain", F.regexp_extract("url_surtkey", r"^([^)]*)", 1).alias("url_surtkey")).agg(F.min("page_id").alias("id"))
    return K.seed_lookup(index, hosts).select("page_id", "seed_id")


@query(f"SELECT page_id, url FROM pages WHERE url IN (SELECT unnest({_LINKS}) FROM pages UNION SELECT regexp_replace(url, '\\?.*$', '') FROM pages)")
def joi_next_lookup(t):
    links = t.pages.select(F.explode(H.links(F.col("html"))).alias("url"))
    plain = t.pages.select(F.regexp_replace("url", r"\?.*$", "").alias("url"))
    return K.next_lookup(t.pages.select("page_id", "url"), links.unionByName(plain))


@query(f"SELECT DISTINCT link AS url FROM (SELECT unnest({_LINKS}) AS link FROM pages) WHERE link NOT IN (SELECT url FROM pages)")
def joi_next_urls(t):
    return K.next_urls(t.pages.select(H.links(F.col("html")).alias("external_urls")), t.pages)


_USERS = "SELECT event_id, 'u' || user_id AS url, ts, ['u' || (user_id + 1), 'u' || (user_id * 2), 'nowhere'] AS external_urls FROM events"


@query(f"WITH p AS ({_USERS}), ids AS (SELECT url, event_id AS id FROM p QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) = 1) SELECT event_id, coalesce((SELECT string_agg(id::VARCHAR, ',' ORDER BY k) FROM (SELECT unnest(external_urls) AS link, generate_subscripts(external_urls, 1) AS k) JOIN ids ON link = ids.url), '') AS external_ids FROM p")
def joi_external_ids(t):
    u = F.col("user_id")
    pages = t.events.select("event_id", F.concat(F.lit("u"), u).alias("url"), "ts", F.array(F.concat(F.lit("u"), u + 1), F.concat(F.lit("u"), u * 2), F.lit("nowhere")).alias("external_urls"))
    return K.external_ids(pages, "event_id", time="ts").select("event_id", F.array_join(F.col("external_ids").cast("array<string>"), ",").alias("external_ids"))


@query("SELECT o_orderkey, c_name, n_name FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def joi_pre_dedup(t):
    one = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    return one.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


_FILES = "SELECT p_partkey AS id, p_name || CASE p_size % 4 WHEN 0 THEN '.py' WHEN 1 THEN '.md' WHEN 2 THEN '.rs' ELSE '' END AS path, p_brand AS repo_name FROM part"


@query(f"SELECT f.id, f.path, f.repo_name AS repo FROM ({_FILES}) f JOIN part ON f.id = p_partkey WHERE regexp_matches(f.path, '\\.(py|rs)$') AND p_size BETWEEN 0 AND 1048575")
def flt_code_query(t):
    end = F.element_at(F.array(*map(F.lit, (".py", ".md", ".rs", ""))), F.pmod(F.col("p_size"), F.lit(4)) + 1)
    files = t.part.select(F.col("p_partkey").alias("id"), F.concat("p_name", end).alias("path"), F.col("p_brand").alias("repo_name"))
    contents = t.part.select(F.col("p_partkey").alias("id"), F.lit(False).alias("binary"), F.col("p_size").alias("size"), F.lit(1).alias("copies"), F.col("p_partkey").alias("content"))
    licences = t.part.select(F.col("p_brand").alias("repo_name")).distinct().withColumn("license", F.lit("mit"))
    return C.code_files(files, contents, licences).select(F.col("content").alias("id"), "path", F.col("repo_name").alias("repo"))


@query("SELECT c_custkey FROM customer WHERE NOT c_mktsegment IN ('BUILDING', 'MACHINERY')")
def flt_not_in(t):
    return t.customer.where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def joi_anti(t):
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("SELECT event_type, CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'unknown' END AS kind, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def joi_dimension_lookup(t):
    names = F.create_map(F.lit("click"), F.lit("click"), F.lit("view"), F.lit("view"))
    return t.events.groupBy("event_type", F.coalesce(names[F.col("event_type")], F.lit("unknown")).alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*)::BIGINT AS captures, count(DISTINCT user_id)::BIGINT AS users, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def agg_coverage(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("captures"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT event_type, sum(n)::BIGINT AS captures, sum(bytes)::BIGINT AS bytes, true AS near, '{' || string_agg('\"' || k || '\":' || n, ',' ORDER BY k) || '}' AS histogram FROM (SELECT event_type, strftime(ts, '%Y-%m') AS k, count(*) AS n, sum(user_id) AS bytes FROM events GROUP BY ALL) GROUP BY event_type")
def agg_coverage_estimates(t):
    """The estimate of distinct users lies within a tenth of their number."""
    found = S.coverage(t.events, "event_type", F.col("user_id"), F.col("user_id"), F.date_format("ts", "yyyy-MM"))
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("urls_estimate") - F.col("users")) <= 0.1 * F.col("users")
    return found.join(exact, "event_type").select("event_type", "captures", "bytes", near.alias("near"), "histogram")


@query("SELECT json_extract_string(props, '$.k') AS key, count(*)::BIGINT AS n FROM events GROUP BY ALL ORDER BY n DESC, key LIMIT 10")
def agg_merge_histograms(t):
    per = t.events.groupBy("user_id", F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n")).groupBy("user_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "n")))).alias("h"))
    return S.merge_histograms(per, "h", 10)


@query("SELECT substr(event_type, 1, 3) AS event_type, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def agg_roll_up(t):
    return S.roll_up(t.events, "event_type", 3, "value").withColumn("value", F.round("value", 4))


@query("SELECT c_mktsegment AS lang, count(*)::BIGINT AS samples, round(sum(c_acctbal), 2) AS size, round(sum(c_acctbal) / count(*), 4) AS per_sample FROM customer GROUP BY ALL")
def agg_sizes_by_language(t):
    sizes = t.customer.select(F.col("c_mktsegment").alias("lang"), F.col("c_acctbal").alias("size"), F.lit(1).cast("bigint").alias("samples"))
    return S.language_sizes(sizes).select("lang", "samples", F.round("size", 2).alias("size"), F.round("per_sample", 4).alias("per_sample"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def agg_concatenate_segments(t):
    parts = t.conversations.select(F.concat_ws("_id_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    return C.concatenate_segments(parts).select(F.col("id").cast("bigint").alias("conv_id"), "text")


@query("SELECT size, count(*)::BIGINT AS clusters FROM (SELECT count(*)::BIGINT AS size FROM orders GROUP BY o_custkey) GROUP BY size")
def agg_group_sizes(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))


@query("SELECT event_id, props AS raw, json_extract_string(props, '$.k') AS k, 'pseudo-crawl--' || user_id AS source_dataset FROM events")
def prj_collapse_meta(t):
    meta = K.collapse(t.events.select("event_id", "props", F.get_json_object("props", "$.k").alias("k"), "user_id"), ["event_id", "props", "user_id"])
    meta = meta.withColumn("meta", K.add_source(F.col("meta"), K.source_name(F.col("user_id"))))
    return meta.select("event_id", F.col("props").alias("raw"), F.get_json_object("meta", "$.k").alias("k"), F.get_json_object("meta", "$.source_dataset").alias("source_dataset"))


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 0 ELSE (user_id % 3)::INT END AS depth FROM events")
def prj_depth(t):
    flavor = F.when(F.col("event_type") == "click", "seed").otherwise(F.concat(F.lit("intermediate_depth_"), F.col("user_id") % 3))
    return t.events.select("event_id", K.depth_of(flavor).alias("depth"))


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN (SELECT l_orderkey, max(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey")
def agg_max_depth(t):
    most = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("l_linenumber"))
    return t.orders.join(most, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_linenumber")


@query("SELECT c_custkey, c_nationkey, round(level, 4) AS level FROM (SELECT c_custkey, c_nationkey, least(coalesce(min(CASE WHEN even <= c_acctbal THEN even END) OVER (PARTITION BY c_nationkey), max(c_acctbal) OVER (PARTITION BY c_nationkey)), c_acctbal) AS level FROM (SELECT *, (least(20000, total) - coalesce(sum(c_acctbal) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (count(*) OVER (PARTITION BY c_nationkey) - row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) + 1) AS even FROM (SELECT c_custkey, c_nationkey, c_acctbal, sum(c_acctbal) OVER (PARTITION BY c_nationkey) AS total FROM customer WHERE c_acctbal > 0)))")
def smp_capped_levels(t):
    sizes = t.customer.where("c_acctbal > 0").select("c_custkey", "c_nationkey", "c_acctbal")
    return M.capped(sizes, 20000, "c_acctbal", "c_nationkey").select("c_custkey", "c_nationkey", F.round("level", 4).alias("level"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def smp_most(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS seqnum FROM orders")
def win_row_number(t):
    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("seqnum"))
