"""Queries over documents: quality, cleaning, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import params as P
from ..functions import text as T
from ..functions.lineage import written
from ..functions.text import lit_sql
from ..operators import cleaning as C
from ..operators import dedup as D
from ..operators import mixing as M
from ..operators import neardup as N
from ..operators import pii
from ..operators import quality as Q
from ..operators import stats as S
from ..registry import query

CHARS = lit_sql(T.SPECIAL)
STRIP = r"regexp_replace({0}, '^[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g')"


def strip_sql(x: str) -> str:
    return STRIP.format(x)


WORDS = f"list_filter(list_transform(list_filter(regexp_split_to_array(text, '[ \\n\\t]'), lambda x: x <> ''), lambda x: trim(lower(x), {CHARS})), lambda x: x <> '')"
_METRICS = f"""
SELECT doc_id, lang, text, w, len(w)::INT AS n_words,
  CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - length(translate(text, {CHARS}, '')))::DOUBLE / length(text) END AS special_ratio,
  CASE WHEN {P.sql_list(P.STOPWORDS)} IS NULL THEN NULL WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: list_contains({P.sql_list(P.STOPWORDS)}, x)))::DOUBLE / len(w) END AS stopword_ratio,
  CASE WHEN {P.sql_list(P.FLAGGED)} IS NULL THEN NULL WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: list_contains({P.sql_list(P.FLAGGED)}, x)))::DOUBLE / len(w) END AS flagged_ratio
FROM (SELECT doc_id, lang, text, {WORDS} AS w FROM documents)"""
_CHAR = f"""
SELECT doc_id, CASE WHEN sum(n) IS NULL THEN 0 ELSE sum(CASE WHEN r <= k THEN n ELSE 0 END)::DOUBLE / sum(n) END AS char_repetition FROM (
  SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC) AS r, least(floor(sqrt(count(*) OVER (PARTITION BY doc_id))), count(*) OVER (PARTITION BY doc_id) - sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id)) AS k
  FROM (SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(range(1, length(text) - 8), lambda i: substr(text, i, 10))) AS g FROM documents) GROUP BY ALL)) GROUP BY doc_id"""
_WORD = f"""
SELECT doc_id, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::DOUBLE / sum(n) AS word_repetition FROM (
  SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM (SELECT doc_id, {WORDS} AS w FROM documents)) GROUP BY ALL) GROUP BY doc_id"""
_ALL = f"WITH m AS ({_METRICS}), c AS ({_CHAR}), r AS ({_WORD}), a AS (SELECT m.*, coalesce(char_repetition, 0) AS char_repetition, coalesce(word_repetition, 0) AS word_repetition FROM m LEFT JOIN c USING (doc_id) LEFT JOIN r USING (doc_id))"
_OK = {
    "words_ok": f"n_words BETWEEN {P.sql_parameter('min_words')} AND {P.sql_parameter('max_words')}",
    "char_repetition_ok": f"char_repetition <= {P.sql_parameter('char_max')}",
    "word_repetition_ok": f"word_repetition <= {P.sql_parameter('word_max')}",
    "special_ok": f"special_ratio <= {P.sql_parameter('special_max')}",
    "stopwords_ok": f"coalesce(stopword_ratio >= {P.sql_parameter('stop_min')}, true)",
    "flagged_ok": f"coalesce(flagged_ratio <= {P.sql_parameter('flagged_max')}, true)",
}


@query(f"SELECT doc_id, n_words, round(special_ratio, 6) AS special_ratio, round(stopword_ratio, 6) AS stopword_ratio, round(flagged_ratio, 6) AS flagged_ratio FROM ({_METRICS})")
def qlt_document_metrics(t):
    m = Q.with_metrics(t.documents, repetition=False)
    return m.select("doc_id", "n_words", *[F.round(c, 6).alias(c) for c in ("special_ratio", "stopword_ratio", "flagged_ratio")])


@query(f"{_ALL} SELECT doc_id, round(char_repetition, 6) AS char_repetition, round(word_repetition, 6) AS word_repetition FROM a")
def qlt_repetition(t):
    m = Q.with_metrics(t.documents)
    return m.select("doc_id", F.round("char_repetition", 6).alias("char_repetition"), F.round("word_repetition", 6).alias("word_repetition"))


@query(f"{_ALL} SELECT doc_id FROM a WHERE " + " AND ".join(_OK.values()))
def qlt_filter_documents(t):
    return Q.filter_documents(t.documents).select("doc_id")


@query(f"{_ALL} SELECT " + ", ".join(f"round(avg(CASE WHEN {c} THEN 0.0 ELSE 1.0 END) * 100, 6) AS {n}" for n, c in _OK.items()) + " FROM a")
def qlt_discarded_by_filter(t):
    return Q.discarded_share(Q.with_metrics(t.documents), Q.checks())


@query(f"{_ALL} SELECT doc_id, " + ", ".join(f"{c} AS {n}" for n, c in _OK.items()) + ", (" + " AND ".join(_OK.values()) + ") AS retained FROM a")
def qlt_cutoff_verdicts(t):
    ok = Q.checks()
    both = None
    for c in ok.values():
        both = c if both is None else both & c
    return Q.with_metrics(t.documents).select("doc_id", *[c.alias(n) for n, c in ok.items()], both.alias("retained"))


@query()
def qlt_repetition_maps(t):
    return Q.repetition_maps(t.documents)


_MARKS_SQL = "text"
_ONE = {k: v for k, v in T.PLAIN_MARKS.items() if len(v) == 1}


def _marks_sql(x: str) -> str:
    x = f"translate({x}, {lit_sql(''.join(_ONE))}, {lit_sql(''.join(_ONE.values()))})"
    for k, v in T.PLAIN_MARKS.items():
        if len(v) > 1:
            x = f"replace({x}, {lit_sql(k)}, {lit_sql(v)})"
    return x


_SPACES = f"translate({{0}}, {lit_sql(T.WIDE_SPACES)}, {lit_sql(' ' * len(T.WIDE_SPACES))})"


@query("SELECT doc_id, " + _marks_sql(f"regexp_replace({_SPACES.format('lower(' + strip_sql(r'regexp_replace(text, ' + chr(39) + r'[\x00-\x1F\x7F-\x{9F}]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')') + ')')}, '\\p{{Nd}}', '0', 'g')".replace("{{", "{").replace("}}", "}")) + " AS text FROM documents")
def qlt_normalize(t):
    return t.documents.select("doc_id", T.normalize(F.col("text")).alias("text"))


_LONG = P.sql_parameter("long_word")
_CORE = f"{{'w': w, 'c': trim(w, {CHARS})}}"
_BAD = "|".join(b.replace(".", "\\.") for b in Q.BAD_PARTS)
_CLEANED = ", ".join(f"'{k}'" for k in P.PARAMETERS if k not in P.KEEP_FRAGMENTS)
_GOOD = f"x.w <> '' AND NOT (cleaned AND regexp_matches(x.c, '{_BAD}')) AND (lw = 0 OR length(x.w) <= lw OR length(x.c) BETWEEN 1 AND lw)"
_CELL = f"array_to_string(list_transform(list_filter(list_transform(string_split(c, ' '), lambda w: {_CORE}), lambda x: {_GOOD}), lambda x: x.w), ' ')"


@query(f"SELECT doc_id, array_to_string(list_filter(list_transform(string_split({_SPACES.format(strip_sql('text'))}, chr(10)), lambda l: array_to_string(list_filter(list_transform(string_split(l, chr(9)), lambda c: {_CELL}), lambda y: y <> ''), chr(9))), lambda y: y <> ''), chr(10)) AS text FROM (SELECT doc_id, text, {_LONG} AS lw, lang IN ({_CLEANED}) AS cleaned FROM documents)")
def qlt_repair(t):
    return t.documents.select("doc_id", Q.repair(F.col("text")).alias("text"))


_LANGS = sorted(P.STOPWORDS)


def vote_sql(source: str, keys: str) -> str:
    """(keys, lang, score) of source (keys, text): the language with the most stop words; of equals the first by name."""
    hits = ", ".join(f"len(list_filter(w, lambda x: list_contains({P.STOPWORDS[k]!r}, x))) AS {k}_n" for k in _LANGS)
    best = "CASE " + " ".join(f"WHEN {k}_n = m THEN '{k}'" for k in _LANGS) + " END"
    return (
        f"SELECT {keys}, CASE WHEN t = 0 THEN 'unknown' ELSE {best} END AS lang, CASE WHEN t = 0 THEN 0 ELSE round(m::DOUBLE / t, 6) END AS score FROM "
        f"(SELECT *, greatest({', '.join(f'{k}_n' for k in _LANGS)}) AS m, {' + '.join(f'{k}_n' for k in _LANGS)} AS t FROM (SELECT {keys}, {hits} FROM (SELECT {keys}, {WORDS} AS w FROM ({source}))))"
    )


@query(vote_sql("SELECT doc_id, text FROM documents", "doc_id"))
def qlt_language_vote(t):
    return t.documents.select("doc_id", Q.vote_language(F.col("text")).alias("v")).select("doc_id", "v.lang", F.round("v.score", 6).alias("score"))


@query(vote_sql("SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents", "doc_id, line"))
def map_line_languages(t):
    lines = t.documents.select("doc_id", F.posexplode(Q.language_info(F.col("text"))["lines"]).alias("line", "v"))
    return lines.select("doc_id", F.col("line").cast("bigint").alias("line"), "v.lang", F.round("v.score", 6).alias("score"))


_SCORED = vote_sql("SELECT doc_id, lang AS want, length(text) AS n, text FROM documents", "doc_id, want, n")


@query(f"SELECT doc_id, coalesce(lang = want AND score >= {P.sql_parameter('lang_min', 'want')}, true) AS language_ok, round(pow(10.0::DOUBLE, n / 2000.0), 1) <= {P.sql_parameter('perplexity_max', 'want')} AS perplexity_ok FROM ({_SCORED})")
def qlt_model_verdicts(t):
    d = t.documents.withColumn("v", Q.vote_language(F.col("text")))
    model = Q.perplexity(-F.length("text").cast("double"), F.lit(2000))  # the place of a language model's sum
    ok = Q.model_checks(F.col("v.lang"), F.round("v.score", 6), model)
    return d.select("doc_id", *[c.alias(n) for n, c in ok.items()])


@query(f"SELECT lang, count(*)::BIGINT AS n, coalesce(sum(length(text)), 0)::BIGINT AS chars FROM documents GROUP BY lang")
def agg_chars_by_language(t):
    return t.documents.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def _map_sql(body: str) -> str:
    return f"SELECT doc_id, {body} AS text FROM documents"


def _drop_lines_sql(parts) -> str:
    return "array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT (" + " OR ".join(f"contains(x, {lit_sql(p)})" for p in parts) + ")), chr(10))"


@query(_map_sql("replace(text, chr(10), ' ')"))
def map_newline_to_space(t):
    return C.apply("replace_newline_with_space", t.documents).select("doc_id", "text")


for _name, _parts in (("remove_lines_with_code", "code"), ("remove_html_spans", "html_spans"), ("remove_html_spans_sanad", "html_spans_sanad"), ("remove_wiki_mojibake", "wiki_mojibake")):
    query(_map_sql(_drop_lines_sql(C.BAD_LINES[_parts])), name=f"map_{_name}")(lambda t, n=_name: C.apply(n, t.documents).select("doc_id", "text"))


@query(_map_sql("regexp_replace(text, '(the of|and to)', '', 'g')"))
def map_strip_substrings(t):
    return t.documents.select("doc_id", C.strip_parts(F.col("text"), ("the of", "and to")).alias("text"))


_REF_WORDS = "list_filter(regexp_split_to_array(x, '[\\s\\x0b]+'), lambda y: y <> '')"


def _references_sql(lang: str) -> str:
    words = f"list_filter(string_split_regex(x, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+'), lambda y: y <> '')"
    ok = f"len(list_filter({words}, lambda y: list_contains({P.STOPWORDS[lang]!r}, y))) > len({words}) * {C.REFERENCE_RATIOS[lang]}::DOUBLE"
    if lang == "zh":
        one = "".join(w for w in P.STOPWORDS["zh"] if len(w) == 1)
        ok = f"length(x) - length(translate(x, '{one}', '')) > length(x) * {C.REFERENCE_RATIOS['zh']}::DOUBLE"
    return f"""SELECT doc_id, array_to_string(l[1:cut], chr(10)) AS text FROM (SELECT doc_id, l, coalesce(list_max(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN ok[i] THEN i ELSE 0 END)), 0) AS cut FROM (
SELECT doc_id, string_split(text, chr(10)) AS l, list_transform(string_split(text, chr(10)), lambda x: {ok}) AS ok FROM documents))"""


for _lang in sorted(C.REFERENCE_RATIOS):
    query(_references_sql(_lang), name=f"map_remove_references_{_lang}")(lambda t, k=_lang: C.apply(f"remove_references_{k}", t.documents).select("doc_id", "text"))


@query("SELECT doc_id, regexp_replace(regexp_replace(text, '([.!?…][\"''”’»)\\]]*)[ \\t]+', '\\1' || chr(1), 'g'), chr(1) || '([^\\s]|$)', chr(10) || '\\1', 'g') AS text FROM documents")
def map_split_sentences_en(t):
    return C.apply("split_sentences_en", t.documents).select("doc_id", "text")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[^\\s\\p{Z}]')")
def flt_non_empty(t):
    return C.apply("filter_remove_empty_docs", t.documents).select("doc_id")


@query("SELECT doc_id FROM documents WHERE len(string_split(text, ' ')) >= 15")
def flt_small_docs(t):
    return C.apply("filter_small_docs", t.documents).select("doc_id")


for _b in (300, 1024):
    query(f"SELECT doc_id FROM documents WHERE octet_length(encode(text)) >= {_b}", name=f"flt_small_docs_bytes_{_b}")(lambda t, b=_b: C.apply(f"filter_small_docs_bytes_{b}", t.documents).select("doc_id"))


@query("SELECT doc_id FROM documents WHERE len(string_split(text, ' ')) < 15")
def flt_reverted(t):
    return t.documents.where(C.revert(C.enough_words(F.col("text")))).select("doc_id")


_META = "CASE WHEN doc_id % 7 = 0 THEN 'User ' || source ELSE source END"


@query(f"SELECT doc_id FROM documents WHERE NOT starts_with({_META}, 'User ') AND (CASE WHEN doc_id % 5 = 0 THEN 'talk' ELSE 'text' END) = 'text'")
def flt_wiki_meta(t):
    title = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("User "), "source")).otherwise(F.col("source"))
    kind = F.when(F.col("doc_id") % 5 == 0, "talk").otherwise("text")
    docs = t.documents.withColumn("meta", F.to_json(F.struct(title.alias("title"), kind.alias("type"))))
    return C.run(docs, ["filter_wiki_user_titles", "filter_wiki_non_text_type"]).select("doc_id")


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL AND length(text) < 20000 AND NOT source IN ('src3', 'src5')")
def flt_prefilter_and_exclusion(t):
    return t.documents.where("text IS NOT NULL").where(F.length("text") < 20000).where(~F.col("source").isin("src3", "src5")).select("doc_id")


_LINES_LEN = "list_transform(string_split(text, chr(10)), lambda x: length(x))"
_TOK = "list_transform(list_filter(regexp_split_to_array(text, '[\\s\\x0b]+'), lambda x: x <> ''), lambda x: length(x)::DOUBLE)"


@query(f"""SELECT doc_id, md5(regexp_replace(text, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+', '', 'g')) AS hash, round(list_avg({_LINES_LEN}), 6) AS line_mean, list_max({_LINES_LEN})::INT AS line_max, CASE WHEN length(text) = 0 THEN 0 ELSE round((length(text) - length(regexp_replace(text, '[\\p{{L}}\\p{{Nd}}]', '', 'g')))::DOUBLE / length(text), 6) END AS alpha_frac,
regexp_matches(lower(array_to_string(string_split(text, chr(10))[1:5], chr(10))), 'auto-generated|autogenerated|automatically generated') AS autogenerated FROM documents""")
def map_code_stats(t):
    s = C.code_stats(F.col("text"))
    return t.documents.select("doc_id", *[s[k].alias(k) for k in ("hash", "line_mean", "line_max", "alpha_frac", "autogenerated")])


_ODD_SHARE = "CASE WHEN length(text) = 0 THEN 1 ELSE 1 - (length(text) - length(regexp_replace(text, '[\\p{L}\\p{Nd}_]', '', 'g')))::DOUBLE / length(text) END"
_LICENCE = "CASE source WHEN 'src0' THEN 'gpl-3.0' WHEN 'src1' THEN 'lgpl-2.1' ELSE 'mit' END"
_CODE_OK = {
    "token_length_ok": f"coalesce(list_stddev_pop({_TOK}), 0) > 3",
    "length_ok": "length(text) > 100 AND length(text) < 200000",
    "special_ok": f"{_ODD_SHARE} > 0.15 AND {_ODD_SHARE} < 0.65",
    "longest_line_ok": f"list_max({_LINES_LEN}) > 20 AND list_max({_LINES_LEN}) < 1000",
    "licence_ok": f"{_LICENCE} = 'mit'",
}


def _licence():
    return F.when(F.col("source") == "src0", "gpl-3.0").when(F.col("source") == "src1", "lgpl-2.1").otherwise("mit")


@query("SELECT doc_id, " + ", ".join(f"({c}) AS {n}" for n, c in _CODE_OK.items()) + " FROM documents")
def flt_code_heuristics(t):
    f = C.code_filters(F.col("text"), _licence())
    return t.documents.select("doc_id", *[c.alias(k) for k, c in f.items()])


@query("SELECT doc_id FROM documents WHERE " + " AND ".join(f"({c})" for c in _CODE_OK.values()))
def flt_code_by_all(t):
    return C.by_all(t.documents, C.code_filters(F.col("text"), _licence())).select("doc_id")


@query(f"SELECT doc_id FROM documents QUALIFY list_max({_LINES_LEN}) <= 1000 AND row_number() OVER (PARTITION BY regexp_replace(text, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+', '', 'g') ORDER BY doc_id) = 1")
def flt_code_unique(t):
    return C.unique_files(t.documents).select("doc_id")


# Deduplication

_DOC_KEY = "md5(" + strip_sql(r"regexp_replace(text, '[\s\x0b\x{85}\p{Z}]+|\p{Nd}+|[!-/:-@\[-`{-~]+', '', 'g')") + ")"


@query(f"SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY {_DOC_KEY} ORDER BY doc_id) = 1 THEN text ELSE '' END AS text FROM documents")
def ddp_document(t):
    return C.apply("dedup_document", t.documents).select("doc_id", "text")


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY replace(text, ' ', '') ORDER BY doc_id) = 1")
def ddp_ignoring_blanks(t):
    return D.drop_copies(t.documents, D.no_blank_key(F.col("text"))).select("doc_id")


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY regexp_replace(text, '[\\s\\x0b\\x{85}\\p{Z}]+', '', 'g') ORDER BY doc_id) = 1")
def ddp_ignoring_space(t):
    return D.drop_copies(t.documents, D.no_space_key(F.col("text"))).select("doc_id")


@query("SELECT doc_id FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1")
def ddp_show_duplicates(t):
    return D.duplicates(t.documents, F.col("text")).select("doc_id")


_L = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents"
_LS = f"SELECT doc_id, pos, {strip_sql('line')} AS line FROM ({_L})"
_JOIN = "SELECT doc_id, coalesce(text, '') AS text FROM (SELECT doc_id FROM documents) LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept GROUP BY doc_id) USING (doc_id)"


def _template_sql(size: int, n: int) -> str:
    return f"WITH l AS ({_LS}), bad AS (SELECT line FROM l WHERE length(line) >= {size} GROUP BY line HAVING count(*) >= {n}), kept AS (SELECT * FROM l WHERE line NOT IN (SELECT line FROM bad)) {_JOIN}"


@query(_template_sql(15, 10))
def ddp_template_soft(t):
    return C.apply("dedup_template_soft", t.documents).select("doc_id", "text")


@query(_template_sql(0, 2))
def ddp_newspapers(t):
    return C.apply("dedup_pseudocrawl_newspapers", t.documents).select("doc_id", "text")


_SKIP = f"""u AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text), n AS (SELECT line, count(*) AS n FROM (SELECT unnest(list_distinct(string_split(text, chr(10)))) AS line FROM u) GROUP BY line),
skip AS (SELECT line, n FROM n WHERE n > greatest(10, 0.01 * (SELECT count(*) FROM u)))"""


@query(f"WITH {_SKIP} SELECT line, n::BIGINT AS n FROM skip")
def ddp_lines_to_skip(t):
    return D.frequent_lines(t.documents, 10, 0.01)


@query(f"WITH {_SKIP}, l AS ({_L}), kept AS (SELECT * FROM l WHERE line NOT IN (SELECT line FROM skip)), o AS ({_JOIN}) SELECT doc_id, {strip_sql('text')} AS text FROM o WHERE length({strip_sql('text')}) > 32")
def ddp_skip_lines(t):
    return D.skip_lines(t.documents, D.frequent_lines(t.documents, 10, 0.01), least_chars=32).select("doc_id", "text")


@query(f"WITH n AS (SELECT line, count(*) AS n FROM (SELECT unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents) GROUP BY line), skip AS (SELECT line FROM n WHERE n > 5), l AS ({_L}), kept AS (SELECT doc_id, pos, line FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS r FROM l) WHERE r = 1 OR line NOT IN (SELECT line FROM skip)) {_JOIN}")
def ddp_first_of_frequent_lines(t):
    skip = D.frequent_lines(t.documents, 5, unique_pages=False)
    return D.first_of_lines(t.documents, skip).select("doc_id", "text")


@query(f"WITH l AS ({_LS}), kept AS (SELECT doc_id, pos, line FROM l WHERE line <> '' QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) = 1) {_JOIN}")
def ddp_first_of_all_lines(t):
    return D.first_of_lines(t.documents).select("doc_id", "text")


@query(f"WITH l AS ({_L}), kept AS (SELECT doc_id, pos, line FROM l QUALIFY line = '' OR row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) = 1) {_JOIN}")
def ddp_lines_within_document(t):
    return t.documents.select("doc_id", D.first_lines_within(F.col("text")).alias("text"))


@query(f"SELECT md5(text) AS h, count(*)::BIGINT AS copies FROM documents GROUP BY text HAVING count(*) > 1")
def ddp_multiplicities(t):
    return D.multiplicities(t.documents)


@query("SELECT round(1 - count(DISTINCT md5(text)) / count(*), 6) AS duplicate_fraction FROM documents")
def ddp_duplicate_fraction(t):
    return D.duplicate_fraction(t.documents, F.md5("text"))


@query(f"WITH l AS ({_LS}) SELECT md5(line) AS h, count(*)::BIGINT AS n FROM l WHERE length(line) >= 15 GROUP BY line HAVING count(*) >= 10")
def agg_line_counts(t):
    lines = D.explode_lines(t.documents, strip=True).where(F.length("line") >= 15)
    return lines.groupBy(F.md5("line").alias("h")).agg(F.count("*").alias("n")).where("n >= 10")


def _hashed(t):
    return t.documents.select("doc_id", N.simhash_column(F.col("text")).alias("hash"))


@query()
def ddp_simhash(t):
    return _hashed(t)


@query()
def ddp_simhash_pairs(t):
    h = written(_hashed(t))
    return N.representative_pairs(h, N.near_pairs(h))


@query()
def ddp_simhash_clusters(t):
    h = written(_hashed(t))
    return N.clusters(h, N.near_pairs(h))


@query()
def agg_hamming_distances(t):
    return N.distance_counts(N.near_pairs(_hashed(t)))


@query()
def agg_cluster_sizes(t):
    h = written(_hashed(t))
    return N.cluster_sizes(N.clusters(h, N.near_pairs(h)))


@query()
def map_pii(t):
    return pii.run_pii(t.documents.select("doc_id", "text")).select("doc_id", "text", "modified", "regex_metadata")


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, '(\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b)', 1), ';') AS mails FROM documents WHERE contains(text, '@')")
def map_find_by_pattern(t):
    found = F.regexp_extract_all("text", F.lit(r"(\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b)"), 1)
    return t.documents.where(F.contains(F.col("text"), F.lit("@"))).select("doc_id", F.array_join(found, ";").alias("mails"))


# Sampling and mixing

_KEY = "md5(doc_id::VARCHAR || '|42')"
_RATIO = "CASE WHEN source = 'src0' THEN 0.25 WHEN source = 'src1' THEN 1.0 ELSE 0.5 END"


@query(f"SELECT doc_id FROM (SELECT doc_id, {_RATIO} AS r, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY {_KEY}, doc_id) AS k FROM documents) WHERE r >= 1 OR k <= floor(n * r)")
def smp_ratio(t):
    r = F.when(F.col("source") == "src0", 0.25).when(F.col("source") == "src1", 1.0).otherwise(0.5)
    return M.sample_ratio(t.documents, r).select("doc_id")


@query(f"SELECT doc_id FROM documents ORDER BY {_KEY}, doc_id LIMIT 100")
def smp_rows(t):
    return M.sample_rows(t.documents, 100).select("doc_id")


@query("SELECT doc_id, ((doc_id % 8) + 8) % 8 AS round_robin FROM documents")
def smp_round_robin(t):
    return t.documents.select("doc_id", M.round_robin(F.col("doc_id"), 8).alias("round_robin"))


@query("SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) - 1 AS shard FROM documents")
def smp_contiguous(t):
    from ..operators.crawl import dense_ids

    rows = dense_ids(t.documents, "doc_id", "row").crossJoin(F.broadcast(t.documents.agg(F.count("*").alias("n"))))
    return rows.select("doc_id", M.contiguous(F.col("row"), F.col("n"), 7).alias("shard"))


_SIZES = "SELECT source, sum(octet_length(encode(text)))::DOUBLE AS size FROM documents GROUP BY source"


def _sizes(t):
    return t.documents.groupBy("source").agg(F.sum(F.octet_length("text")).cast("double").alias("size"))


@query(f"SELECT source, round(pow(size / sum(size) OVER (), 0.3) / sum(pow(size / (SELECT sum(size) FROM ({_SIZES})), 0.3)) OVER (), 9) AS share FROM ({_SIZES})")
def smp_alpha(t):
    return M.alpha_shares(_sizes(t)).select("source", F.round("share", 9).alias("share"))


@query(f"""WITH s AS ({_SIZES}), o AS (SELECT *, (1000000 - coalesce(sum(size) OVER (ORDER BY size, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (count(*) OVER () - row_number() OVER (ORDER BY size, source) + 1) AS even FROM s)
SELECT source, round(least(coalesce((SELECT min(even) FROM o WHERE even <= size), (SELECT max(size) FROM o)), size), 4) AS level FROM o""")
def smp_water_level(t):
    return M.water_level(_sizes(t), 1_000_000).select("source", F.round("level", 4).alias("level"))


@query("SELECT least(greatest(ceil(coalesce(sum(octet_length(encode(text))), 0) / 500000), 1), count(*))::BIGINT AS shards FROM documents")
def smp_shard_count(t):
    return M.shard_count(t.documents, 500_000).select(F.col("shards").cast("bigint").alias("shards"))


@query("SELECT source, sum(1)::BIGINT AS n FROM (SELECT source, unnest(range(0, (m // n + CASE WHEN k < m % n THEN 1 ELSE 0 END)::BIGINT)) FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k, count(*) OVER (PARTITION BY source) AS n, (SELECT max(c) FROM (SELECT count(*) AS c FROM documents GROUP BY source)) AS m FROM documents)) GROUP BY source")
def smp_oversample(t):
    return M.oversample(t.documents.select("doc_id", "source"), "source", "doc_id").groupBy("source").agg(F.count("*").alias("n"))


# Statistics


@query("SELECT lang, count(*)::BIGINT AS docs, round(avg(octet_length(encode(text))), 6) AS mean, median(octet_length(encode(text)))::DOUBLE AS median, count(*) FILTER (octet_length(encode(text)) = 0)::BIGINT AS empty FROM documents GROUP BY lang")
def agg_lengths(t):
    return S.lengths(t.documents, "lang").withColumn("mean", F.round("mean", 6))


@query("SELECT doc_id FROM documents WHERE n_chars <= (SELECT quantile_cont(n_chars, 0.99) FROM documents)")
def agg_percentile_clip(t):
    return S.percentile_clip(t.documents.select("doc_id", "n_chars"), "n_chars").select("doc_id")


_CLIPPED = "WITH m AS (SELECT median(n_chars) AS m FROM documents), d AS (SELECT median(abs(n_chars - m)) AS d FROM documents, m), k AS (SELECT doc_id, n_chars::DOUBLE AS v FROM documents, m, d WHERE m = 0 OR abs(n_chars - m) < 9 * d)"


@query(f"{_CLIPPED} SELECT doc_id FROM k")
def agg_mad_clip(t):
    return S.without_outliers(t.documents.select("doc_id", "n_chars"), "n_chars").select("doc_id")


@query(f"{_CLIPPED}, e AS (SELECT min(v) AS lo, max(v) AS hi FROM k) SELECT least(floor(CASE WHEN hi = lo THEN 0 ELSE (v - lo) * 50 / (hi - lo) END), 49)::INT AS bin, count(*)::BIGINT AS n FROM k, e GROUP BY ALL")
def agg_clipped_histogram(t):
    return S.clipped_histogram(t.documents, "n_chars")


@query("SELECT CASE WHEN n_chars < 0 THEN -1 WHEN n_chars > 10000 THEN 20 ELSE least(floor(n_chars / 500), 19) END::INT AS bin, count(*)::BIGINT AS n FROM documents GROUP BY ALL")
def agg_histogram(t):
    return S.histogram(t.documents, "n_chars", 0, 10000, 20)


@query("WITH a AS (SELECT count(*) AS r, coalesce(sum(octet_length(encode(text))), 0) AS b FROM documents), k AS (SELECT count(*) AS r, coalesce(sum(octet_length(encode(text))), 0) AS b FROM documents WHERE len(string_split(text, ' ')) >= 15) SELECT a.r::BIGINT AS rows_before, a.b::BIGINT AS bytes_before, k.r::BIGINT AS rows_after, k.b::BIGINT AS bytes_after, round(100 * (a.r - k.r)::DOUBLE / a.r, 6) AS rows_removed_percent, round(100 * (a.b - k.b)::DOUBLE / a.b, 6) AS bytes_removed_percent FROM a, k")
def agg_step_stats(t):
    return C.step_stats(t.documents, C.apply("filter_small_docs", t.documents))


@query("SELECT doc_id, text AS old_text, NULL::VARCHAR AS text FROM documents WHERE NOT len(string_split(text, ' ')) >= 15")
def snk_step_changes(t):
    return C.changes(t.documents, C.apply("filter_small_docs", t.documents))


@query(f"SELECT word, count(*)::BIGINT AS n, row_number() OVER (ORDER BY count(*) DESC, word)::INT AS rank FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word")
def agg_zipf(t):
    return S.zipf(t.documents.select(F.explode(T.words(F.col("text"))).alias("word")))


@query("SELECT DISTINCT lang, source FROM documents")
def agg_distinct_pairs(t):
    return t.documents.select("lang", "source").distinct()


@query("SELECT quality::INT AS quality, count(*)::BIGINT AS n, round(avg(n_chars), 6) AS mean_chars FROM documents JOIN labels USING (doc_id) GROUP BY quality")
def agg_by_label(t):
    return t.documents.join(t.labels, "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))


@query("SELECT doc_id, octet_length(encode(text))::INT AS len FROM documents")
def prj_lengths(t):
    return t.documents.select("doc_id", F.octet_length("text").alias("len"))


@query("SELECT doc_id, lang, length(text) AS n, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS id FROM documents")
def prj_dense_ids(t):
    from ..operators.crawl import dense_ids

    return dense_ids(t.documents, "doc_id").select("doc_id", "lang", F.length("text").alias("n"), "id")


@query(f"SELECT doc_id, CASE lang {' '.join(f'WHEN {lit_sql(k)} THEN {lit_sql(v)}' for k, v in P.LANGUAGE_NAMES.items())} END AS language FROM documents")
def prj_language_names(t):
    names = F.create_map(*[F.lit(x) for kv in P.LANGUAGE_NAMES.items() for x in kv])
    return t.documents.select("doc_id", names[F.col("lang")].alias("language"))


@query("SELECT doc_id, source, lang FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, source, lang FROM documents WHERE doc_id % 2 = 1")
def set_union_all(t):
    d = t.documents.select("doc_id", "source", "lang")
    return d.where("doc_id % 2 = 0").unionByName(d.where("doc_id % 2 = 1"))


@query("SELECT source FROM documents EXCEPT SELECT source FROM documents WHERE n_chars > 20000")
def set_difference(t):
    return t.documents.select("source").distinct().join(t.documents.where("n_chars > 20000").select("source"), "source", "left_anti")
