"""Named maps and filters over documents, and the dispatch that applies them in sequence."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import params as P
from ..functions import text as T
from . import dedup as D

BAD_LINES = {
    "code": "<script|[if|}|{".split("|"),
    "html_spans": "br>|</a>|<a|</div>|<div|</span>|<span".split("|"),
    "html_spans_sanad": "xtImg|var |//DW|]]>|<![CDATA|<img|To view this video please enable JavaScript".split("|"),
    "wiki_mojibake": ["À À"],
}
WIKTIONARY_PARTS = [
    "This entry needs audio files",
    "This entry needs quotations to illustrate usage",
    "This entry needs pronunciation information",
    "Please see that page for discussion and justifications",
    "If you are familiar with the IPA then please add some!",
    "A user has added this entry to requests for deletion(+)",
]
#: Languages whose references can be told: those with stop words.
REFERENCE_RATIOS = {k: P.PARAMETERS.get(k, P.PARAMETERS["default"])["stop_min"] for k in P.STOPWORDS}
SPLIT_LANGUAGES = ("ar", "bn", "ca", "en", "es", "eu", "fr", "gu", "hi", "id", "kn", "ml", "mr", "pa", "pt", "ta", "te", "ur", "vi", "zh")


def newline_to_space(c: Column) -> Column:
    return F.translate(c, "\n", " ")


def drop_lines_with(c: Column, parts) -> Column:
    """The text without the lines that hold any of the literal parts."""
    bad = F.array(*map(F.lit, parts))
    return F.array_join(F.filter(T.lines(c), lambda x: ~F.exists(bad, lambda b: F.contains(x, b))), "\n")


def strip_parts(c: Column, parts) -> Column:
    """The text without the literal parts, the first of the list first where two start alike."""
    return F.regexp_replace(c, "|".join(r"\Q" + p + r"\E" for p in parts), "")


def remove_references(c: Column, lang: str) -> Column:
    """The text up to the last line in which stop words exceed their least share; empty if none does.  A language without stop words is an error.

    Chinese lines have no blanks: there the share is of characters that stop words cover.
    """
    if lang not in REFERENCE_RATIOS:
        raise KeyError(f"there are no stop words of {lang}")
    share, stop = REFERENCE_RATIOS[lang], P.STOPWORDS[lang]

    def passes(line: Column) -> Column:
        if lang == "zh":
            one = F.lit("[" + "".join(w for w in stop if len(w) == 1) + "]")
            return F.regexp_count(line, one) > F.length(line) * F.lit(share)
        w = F.filter(F.split(line, r"(?U)\s+"), lambda x: x != "")
        return F.size(F.filter(w, lambda x: x.isin(stop))) > F.size(w) * F.lit(share)

    ok = F.transform(T.lines(c), lambda x, i: F.when(passes(x), i + 1).otherwise(0))
    return F.array_join(F.slice(T.lines(c), F.lit(1), F.coalesce(F.array_max(ok), F.lit(0))), "\n")


def split_sentences(c: Column, lang: str = "en") -> Column:
    """One sentence a line; a full stop of the script, closing marks and white space end a sentence."""
    ends = {"zh": "。！？", "hi": "।?!", "bn": "।?!", "mr": "।.?!", "gu": "।.?!", "pa": "।.?!", "ur": "۔؟!", "ar": ".؟!"}.get(lang, ".!?…")
    gap = r"\s*" if lang == "zh" else r"[ \t]+"
    return F.regexp_replace(c, "([" + ends + r"][\"'”’»)\]]*)" + gap + r"(?=\S)", "$1\n")


def sentence_splitter(make: Callable[[], Callable[[str], list[str]]]) -> Callable[[Column], Column]:
    """A splitter made once per Python worker, as a column function: the place for a trained one."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        split = make()
        for b in batches:
            yield b.map(lambda t: None if t is None else "\n".join(split(t)))

    return run


def non_empty(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def not_user_title(meta: Column) -> Column:
    return ~F.coalesce(F.startswith(F.get_json_object(meta, "$.title"), F.lit("User ")), F.lit(False))


def is_text_type(meta: Column) -> Column:
    return F.coalesce(F.get_json_object(meta, "$.type") == "text", F.lit(False))


def enough_words(c: Column, least: int = 15) -> Column:
    """Counts what stands between single blanks, empties too."""
    return F.size(F.split(c, " ")) >= least


def enough_bytes(c: Column, least: int) -> Column:
    return F.octet_length(c) >= least


def revert(condition: Column) -> Column:
    """The rows that a filter removes; an unknown condition counts as false."""
    return ~F.coalesce(condition, F.lit(False))


def _map(f: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("text", f(F.col("text")))


def _where(f: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.where(f())


MAPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "replace_newline_with_space": _map(newline_to_space),
    "remove_lines_with_code": _map(partial(drop_lines_with, parts=BAD_LINES["code"])),
    "remove_html_spans": _map(partial(drop_lines_with, parts=BAD_LINES["html_spans"])),
    "remove_html_spans_sanad": _map(partial(drop_lines_with, parts=BAD_LINES["html_spans_sanad"])),
    "remove_wiki_mojibake": _map(partial(drop_lines_with, parts=BAD_LINES["wiki_mojibake"])),
    "strip_substrings_en_wiktionary": _map(partial(strip_parts, parts=WIKTIONARY_PARTS)),
    **{f"remove_references_{k}": _map(partial(remove_references, lang=k)) for k in sorted(REFERENCE_RATIOS)},
    **{f"split_sentences_{k}": _map(partial(split_sentences, lang=k)) for k in SPLIT_LANGUAGES},
}
FILTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "filter_remove_empty_docs": _where(lambda: non_empty(F.col("text"))),
    "filter_wiki_user_titles": _where(lambda: not_user_title(F.col("meta"))),
    "filter_wiki_non_text_type": _where(lambda: is_text_type(F.col("meta"))),
    "filter_small_docs": _where(lambda: enough_words(F.col("text"))),
    "filter_small_docs_bytes_300": _where(lambda: enough_bytes(F.col("text"), 300)),
    "filter_small_docs_bytes_1024": _where(lambda: enough_bytes(F.col("text"), 1024)),
}
_URL = lambda: F.get_json_object("meta", "$.url")
DEDUPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dedup_template_soft": lambda df: D.drop_template_lines(df, 15, 10),
    "dedup_pseudocrawl_newspapers": lambda df: D.drop_template_lines(df, 0, 2),
    "dedup_document": lambda df: D.blank_copies(df, D.document_key(F.col("text"))),
    "dedup_document_on_url": lambda df: D.blank_copies(df, D.url_key(_URL())),
    "dedup_document_on_url_lm_es_pseudocrawl-filtered_341_es_cointelegraph_com": lambda df: D.blank_copies(df, D.amp_key(_URL())),
    "dedup_document_on_url_lm_en_pseudocrawl_filtered_619_www_qut_edu_au": lambda df: D.blank_copies(df, D.id_parameter_key(_URL())),
    "concatenate_lm_fr_ester": lambda df: concatenate_segments(df),
}
PLANS = {
    "crawl": ("dedup_document_on_url", "dedup_document", "dedup_pseudocrawl_newspapers", "filter_remove_empty_docs"),
    "default": ("dedup_document", "dedup_template_soft", "filter_remove_empty_docs"),
}
assert not (MAPS.keys() & FILTERS.keys() | MAPS.keys() & DEDUPS.keys() | FILTERS.keys() & DEDUPS.keys())


def concatenate_segments(df: DataFrame, id_col: str = "id", mark: str = "_id_") -> DataFrame:
    """Segments of a document joined by newlines in the order of the number after the mark in their id."""
    doc, seg = F.substring_index(id_col, mark, 1), F.substring_index(id_col, mark, -1).cast("int")
    parts = F.array_sort(F.collect_list(F.struct(F.col("seg"), F.col("text"))))
    return df.select(doc.alias(id_col), seg.alias("seg"), "text").groupBy(id_col).agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"))


def apply(name: str, df: DataFrame) -> DataFrame:
    """One operator of the registries by name; KILL gives no rows."""
    if name == "KILL":
        return df.limit(0)
    for table in (MAPS, FILTERS, DEDUPS):
        if name in table:
            return table[name](df)
    raise KeyError(f"no operator is called {name}")


def run(df: DataFrame, names) -> DataFrame:
    """Operators one after the other."""
    return reduce(lambda d, n: apply(n, d), names, df)


def changes(before: DataFrame, after: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Side output of a step: (id, old_text, text) of rows that it changed, with a null text where it removed them."""
    old, new = before.select(id_col, F.col("text").alias("old_text")), after.select(id_col, "text", F.lit(True).alias("kept"))
    joined = old.join(new, id_col, "left")
    return joined.where(F.col("kept").isNull() | ~F.col("old_text").eqNullSafe(F.col("text"))).select(id_col, "old_text", "text")


def step_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and bytes before and after, and the percentage removed."""

    def sums(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(F.count("*").alias(f"rows_{tag}"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias(f"bytes_{tag}"))

    both = sums(before, "before").crossJoin(sums(after, "after"))

    def gone(k: str) -> Column:
        return F.round(100 * T.ratio(F.col(f"{k}_before") - F.col(f"{k}_after"), F.col(f"{k}_before")), 6).alias(f"{k}_removed_percent")

    return both.select("*", gone("rows"), gone("bytes"))


# Heuristics over source files

LICENCES_GPL = ("gpl-2.0", "gpl-3.0", "agpl-3.0", "lgpl-2.1", "lgpl-3.0")
CODE_SUFFIXES = tuple("C H c++ cc cpp cs go h++ hh hpp java js lua php php3 php4 php5 phps phpt py rb rs scala ts tsx".split())
GENERATED = ("auto-generated", "autogenerated", "automatically generated")
LARGEST_FILE = 1048575


def code_stats(content: Column) -> dict[str, Column]:
    """Hash without white space, mean and longest line, alphanumeric share, and whether the first five lines say it is generated."""
    size = F.transform(T.lines(content), F.length)
    return {
        "hash": F.md5(F.regexp_replace(content, r"(?U)\s+", "")),
        "line_mean": F.round(F.aggregate(size, F.lit(0.0), lambda a, x: a + x) / F.size(size), 6),
        "line_max": F.array_max(size),
        "alpha_frac": F.round(T.ratio(F.regexp_count(content, F.lit(r"(?U)[\p{Alnum}]")), F.length(content)), 6),
        "autogenerated": F.exists(F.slice(T.lines(content), 1, 5), lambda x: F.lower(x).rlike("|".join(GENERATED))),
    }


def token_length_std(c: Column) -> Column:
    """Population deviation of the lengths of what white space separates.

    Lengths are taken up one by one (Welford), in the order of the text, as SQL
    engines do it: a difference of sums errs otherwise in the last digits, which
    decide where the deviation is a round number.
    """
    n = F.transform(F.filter(F.split(c, r"\s+"), lambda x: x != ""), lambda x: F.length(x).cast("double"))

    def step(a, x):
        k = a["k"] + 1
        mean = a["mean"] + (x - a["mean"]) / k
        return F.struct(k.alias("k"), mean.alias("mean"), (a["squares"] + (x - mean) * (x - a["mean"])).alias("squares"))

    start = F.struct(F.lit(0.0).alias("k"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    return F.coalesce(F.aggregate(n, start, step, lambda a: F.when(a["k"] > 1, F.sqrt(a["squares"] / a["k"])).otherwise(0.0)), F.lit(0.0))


def code_filters(content: Column, licence: Column | None = None, keep_gpl: bool = False) -> dict[str, Column]:
    alnum = T.ratio(F.regexp_count(content, F.lit(r"(?U)\w")), F.length(content))
    longest = F.array_max(F.transform(T.lines(content), F.length))
    found = {
        "token_length_ok": token_length_std(content) > 3,
        "length_ok": (F.length(content) > 100) & (F.length(content) < 200000),
        "special_ok": (1 - alnum > 0.15) & (1 - alnum < 0.65),
        "longest_line_ok": (longest > 20) & (longest < 1000),
    }
    if licence is not None:
        gpl = licence.isin(*LICENCES_GPL)
        found["licence_ok"] = gpl if keep_gpl else ~gpl
    return found


def by_all(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that meet every condition; an unknown one counts as false."""
    return reduce(lambda d, c: d.where(F.coalesce(c, F.lit(False))), conditions.values(), df)


def unique_files(df: DataFrame, id_col: str = "doc_id", longest: int = 1000) -> DataFrame:
    """The first file of each hash without white space, if no line of it is longer than ``longest``."""
    first = D.drop_copies(df, D.no_space_key(F.col("text")), id_col)
    return first.where(F.array_max(F.transform(T.lines(F.col("text")), F.length)) <= longest)


def dataset_language(name: Column) -> Column:
    """Language of a dataset name like lm_xx_name; the two Chinese scripts have names of their own."""
    lang = F.regexp_extract(name, r"^(?:.*/)?lm_([a-z]+(?:-[a-z]+)?)_", 1)
    return F.when(lang.isin("zh-cn", "zhs", "zh-hans"), "zhs").when(lang.isin("zh-tw", "zht", "zh-hant"), "zht").otherwise(lang)


def code_files(files: DataFrame, contents: DataFrame, licences: DataFrame) -> DataFrame:
    """Source files by suffix and size: one row per file id (the least path), with content and licence."""
    one = files.groupBy("id").agg(F.min(F.struct("path", "repo_name")).alias("f")).select("id", "f.path", "f.repo_name")
    wanted = F.substring_index("path", ".", -1).isin(*CODE_SUFFIXES) & F.contains(F.col("path"), F.lit("."))
    text = contents.where(~F.col("binary") & F.col("size").between(0, LARGEST_FILE))
    return one.where(wanted).join(text, "id").join(licences, "repo_name").select("repo_name", "path", "copies", "size", "content", "license")
