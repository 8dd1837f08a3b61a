"""Exact deduplication of documents and lines.

The first row by id wins everywhere, which an aggregate decides, so no state is
carried through rows.  A null id comes last; of rows with one id the one whose
text has the least hash comes first, and of rows equal in id and text any one.

Lines are counted by two 64-bit hashes with partial aggregation, and only the
hashes, ids and positions of the lines that must go are shuffled; texts stay in
place and are cut by position.  Rows equal in id and text are one document there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U


def text_key(c: Column) -> Column:
    return F.md5(T.unicode_strip(c))


def document_key(c: Column) -> Column:
    """Hash of the text without white space, digits and ASCII punctuation."""
    return text_key(F.regexp_replace(c, r"(?U)\s+|(?U)\d+|[!-/:-@\[-`{-~]+", ""))


def no_blank_key(c: Column) -> Column:
    return F.md5(F.replace(c, F.lit(" "), F.lit("")))


def no_space_key(c: Column) -> Column:
    return F.md5(F.regexp_replace(c, r"(?U)\s+", ""))


def url_key(url: Column) -> Column:
    return F.md5(U.before_query(url))


def strict_url_key(url: Column) -> Column:
    return F.md5(url)


def amp_key(url: Column) -> Column:
    """The URL up to its query or to /amp."""
    return F.md5(F.regexp_extract(url, r"^(.*?)(?:/amp(?:$|[/?#])|\?|$)", 1))


def id_parameter_key(url: Column) -> Column:
    """The URL with only its id parameters, both under one name."""
    return F.md5(U.keep_parameters(url, {"id": "id", "news-id": "id"}))


def _ranked(df: DataFrame, key: Column, id_col: str, text_col: str) -> DataFrame:
    """df with __first: whether a row is the one of its key that stays.

    Ids, keys and hashes are aggregated; only rows that share key, id and text
    with the first, which no column tells apart, are numbered by a window.
    """
    this = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    rows = df.withColumns({"__key": key, "__this": this})
    alike = rows.groupBy("__key", "__this").agg(F.count("*").alias("n"))
    firsts = alike.groupBy("__key").agg(F.min(F.struct("__this", "n")).alias("f")).select(F.col("__key").alias("k"), F.col("f.__this").alias("t"), F.col("f.n").alias("many"))
    joined = rows.join(firsts, F.col("__key").eqNullSafe(F.col("k")) & F.col("__this").eqNullSafe(F.col("t")), "left").drop("k", "t")
    single = joined.where("many IS NULL OR many = 1").withColumn("__first", F.col("many").isNotNull())
    several = joined.where("many > 1").withColumn("__first", F.row_number().over(Window.partitionBy("__key", "__this").orderBy(F.lit(1))) == 1)
    return single.unionByName(several).drop("__key", "__this", "many")


def blank_copies(df: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """Every row stays; the text of all but the first row of a key becomes empty.  A null key is a key like others."""
    return _ranked(df, key, id_col, "text").withColumn("text", F.when(F.col("__first"), F.col("text")).otherwise(F.lit(""))).select(*df.columns)


def drop_copies(df: DataFrame, key: Column, id_col: str = "doc_id", text_col: str | None = None) -> DataFrame:
    """The first row of every key."""
    text_col = text_col or ("text" if "text" in df.columns else df.columns[-1])
    return _ranked(df, key, id_col, text_col).where("__first").select(*df.columns)


def duplicates(df: DataFrame, key: Column) -> DataFrame:
    """All rows whose key occurs more than once; the keys are counted, the rows joined to those."""
    keyed = df.withColumn("__key", key)
    many = keyed.groupBy("__key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("__key").alias("k"))
    return keyed.join(many, F.col("__key").eqNullSafe(F.col("k")), "left_semi").drop("__key")


def explode_lines(df: DataFrame, id_col: str = "doc_id", strip: bool = False) -> DataFrame:
    line = T.unicode_strip(F.col("line")) if strip else F.col("line")
    return df.select(id_col, F.posexplode(T.lines(F.col("text"))).alias("pos", "line")).withColumn("line", line)


def join_lines(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(id_col).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))


def _line_keys(df: DataFrame, id_col: str, strip: bool) -> DataFrame:
    """(id, v, pos, a, b, len): the hashes of every line; v is a hash of the text."""
    lines = T.lines(F.col("text"))
    lines = F.transform(lines, T.unicode_strip) if strip else lines
    return df.select(F.col(id_col).alias("id"), F.xxhash64("text").alias("v"), F.posexplode(lines).alias("pos", "line")).select(
        "id", "v", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"), F.length("line").alias("len")
    )


def _without(df: DataFrame, gone: DataFrame, id_col: str, strip: bool, empty: bool = True) -> DataFrame:
    """df without the lines at the positions (id, v, pos) of ``gone``, and without empty ones unless ``empty``; null texts become empty."""
    per = gone.groupBy(F.col("id").alias("__id"), F.col("v").alias("__v")).agg(F.collect_set("pos").alias("__gone"))
    lines = T.lines(F.col("text"))
    lines = F.transform(lines, T.unicode_strip) if strip else lines
    kept = F.when(F.col("__gone").isNull(), lines).otherwise(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__gone"), i)))
    kept = kept if empty else F.filter(kept, lambda x: x != "")
    joined = df.join(per, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__v")), "left")
    return joined.withColumn("text", F.coalesce(F.array_join(kept, "\n"), F.lit(""))).select(*df.columns)


def template_lines(df: DataFrame, least_length: int, least_count: int, id_col: str = "doc_id") -> DataFrame:
    """(a, b): hashes of the stripped lines of some length that occur often in the corpus."""
    lines = _line_keys(df, id_col, strip=True).where(F.col("len") >= least_length)
    return lines.groupBy("a", "b").count().where(F.col("count") >= least_count).select("a", "b")


def drop_template_lines(df: DataFrame, least_length: int = 15, least_count: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Documents without template lines; the lines that stay are stripped."""
    bad = template_lines(df, least_length, least_count, id_col)
    gone = _line_keys(df, id_col, strip=True).where(F.col("len") >= least_length).join(bad, ["a", "b"], "left_semi")
    return _without(df, gone, id_col, strip=True)


def frequent_lines(df: DataFrame, least: int, share: float | None = None, unique_pages: bool = True, per_document: bool = True, id_col: str = "doc_id") -> DataFrame:
    """(line, n) of the lines in more documents than ``least`` and than ``share`` of them.

    unique_pages counts equal texts once; per_document counts a line once in a
    document.
    """
    docs = df.groupBy("text").agg(F.min(id_col).alias(id_col)) if unique_pages else df
    parts = F.array_distinct(T.lines(F.col("text"))) if per_document else T.lines(F.col("text"))
    counts = docs.select(F.explode(parts).alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    if share is None:
        return counts.where(F.col("n") > least)
    total = docs.agg(F.count("*").alias("docs"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("n") > F.greatest(F.lit(float(least)), F.col("docs") * share)).select("line", "n")


def _skip_keys(skip: DataFrame) -> DataFrame:
    return skip.select(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")).distinct()


def skip_lines(df: DataFrame, skip: DataFrame, id_col: str = "doc_id", least_chars: int | None = None) -> DataFrame:
    """Documents without the lines of ``skip``, stripped; those of least_chars characters or fewer are dropped."""
    gone = _line_keys(df, id_col, strip=False).join(_skip_keys(skip), ["a", "b"], "left_semi")
    out = _without(df, gone, id_col, strip=False).withColumn("text", T.unicode_strip(F.col("text")))
    return out if least_chars is None else out.where(F.length("text") > least_chars)


def first_of_lines(df: DataFrame, skip: DataFrame | None = None, id_col: str = "doc_id", preserve: Column | None = None) -> DataFrame:
    """Documents in which a line of ``skip`` (without it: any non-empty stripped line) stays only where the corpus has it first.

    With skip other lines stay as they are; without, empty lines go.  Documents
    that ``preserve`` marks are not touched, nor do they count.
    """
    todo = df if preserve is None else df.where(~preserve)
    keys = _line_keys(todo, id_col, strip=skip is None)
    some = keys.where("len > 0") if skip is None else keys.join(_skip_keys(skip), ["a", "b"], "left_semi")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("v"), F.col("pos"))
    # Lines that occur once have no position to give up, so only the others are joined.
    firsts = some.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    gone = some.join(firsts, ["a", "b"]).where(~place.eqNullSafe(F.col("first"))).select("id", "v", "pos")
    out = _without(todo, gone, id_col, strip=skip is None, empty=skip is not None)
    return out if preserve is None else out.unionByName(df.where(preserve))


def first_lines_within(c: Column) -> Column:
    """A text with only the first of equal non-empty lines."""
    ls = T.lines(c)
    return F.array_join(F.filter(ls, lambda x, i: (x == "") | (F.array_position(ls, x) == i + 1)), "\n")


def multiplicities(df: DataFrame) -> DataFrame:
    """(h, copies) of texts that occur more than once."""
    return df.groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_fraction(df: DataFrame, key: Column) -> DataFrame:
    return df.agg(F.round(1 - F.count_distinct(key) / F.count("*"), 6).alias("duplicate_fraction"))
