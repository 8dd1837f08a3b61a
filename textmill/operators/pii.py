"""Detection and redaction of personal data by regular expressions, in the JVM.

Matches are found tag by tag in the order EMAIL, USER, IP_ADDRESS, KEY and
redacted in that order, each matched string wherever it occurs in the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EDGE = r"\s@,?!;:'\")(.\p{IsHan}"
_OCTET = r"(?:25[0-5]|(?:2[0-4]|1?\d)?\d|[01]\d\d)"
_HEX = "[0-9a-fA-F]{1,4}"
IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
#: Eight groups, or fewer around one double colon.
IPV6 = rf"(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?"
_DASH, _JOIN = r"\p{Pd}", r"\p{Pd}/+=:"
#: Letters and digits in turns, or blocks of digits and capitals; a cheap test comes before it.
KEY = rf"(?:(?:[A-Za-z]++[\p{{Nd}}{_JOIN}_]++|[\p{{Nd}}{_JOIN}]++[A-Za-z]++){{4,}}|(?:(?:\p{{Nd}}{{3,}}+|[A-Z]++\p{{Nd}}++[A-Z]*+|\p{{Nd}}++[A-Z]++\p{{Nd}}*+)[ {_DASH}]?){{3,}})"
ID = rf"[A-Za-z]*+(?:{_DASH}*+\p{{Nd}}){{6,}}"
PHONE = rf"(?:\+\p{{Nd}}+[ /.{_DASH}]*)?(?:\(\+?\p{{Nd}}+\))?(?:[ /.{_DASH}]*\p{{Nd}}){{7,}}"

PATTERNS = {
    "EMAIL": rf"(?m)(?<=^|[{_EDGE}<])([^\s@?!;,:)('\"<]+@[^\s@!?;,/]*[^\s@?!;,/:)('\">.]\.\p{{L}}[\p{{L}}\p{{Nd}}_]+)(?=$|[{_EDGE}>])",
    "USER": r"(?m)(?<=^|[)(\s@,?!;:'\"\p{IsHan}])(@[^)(\s@,?!;:'\"]{3,})",
    "IP_ADDRESS": rf"(?m)(?:^|[{_EDGE}])({IPV4}|{IPV6})(?=$|[{_EDGE}])",
    "KEY": rf"(?m)(?:^|[{_EDGE}])({KEY})(?=$|[{_EDGE}])",
    "ID": rf"(?m)(?:^|[{_EDGE}])({ID})(?=$|[{_EDGE}])",
    "PHONE": rf"(?m)(?:^|[{_EDGE}])({PHONE})(?=$|[{_EDGE}])",
}
ACTIVE = ("EMAIL", "USER", "IP_ADDRESS", "KEY")
#: What a text must hold before the full pattern is tried.
_QUICK = {"EMAIL": "@", "USER": "@", "IP_ADDRESS": r"[0-9a-fA-F][.:]", "KEY": r"\p{Nd}", "ID": r"\p{Nd}", "PHONE": r"\p{Nd}"}
_Y, _DM, _SEP = "[12][0-9]{3}", "[0-3][0-9]", r"[\p{Pd}/.]"
DATES = rf"^(?:{_Y}[\p{{Pd}}/]{_Y}|{_Y}{_SEP}{_DM}{_SEP}{_DM}|{_DM}{_SEP}{_DM}{_SEP}(?:{_Y}|[0-9]{{2}})|{_DM}[\p{{Pd}}/](?:{_Y}|[0-9]{{2}})|{_Y}-{_DM})(?:$|[{_EDGE}])"


def has_digit(c: Column) -> Column:
    return c.rlike("[0-9]")


def looks_like_date(c: Column) -> Column:
    return c.rlike(DATES)


def matches(c: Column, tag: str) -> Column:
    """Strings of one tag, in order; addresses without a digit and those that are dates are left out."""
    none = F.array().cast("array<string>")
    found = F.when(c.rlike(_QUICK[tag]), F.regexp_extract_all(c, F.lit(PATTERNS[tag]), 1)).otherwise(none)
    if tag == "IP_ADDRESS":
        found = F.filter(found, lambda m: has_digit(m) & ~looks_like_date(m))
    return found


def detect(c: Column, tags=ACTIVE) -> Column:
    """array<struct<tag, match>> of all tags."""

    def tagged(tag: str) -> Column:
        return F.transform(matches(c, tag), lambda m: F.struct(F.lit(tag).alias("tag"), m.alias("match")))

    return F.flatten(F.array(*map(tagged, tags)))


def spans(c: Column, found: Column) -> Column:
    """array<struct<tag, match, start, end>>: every place (characters from 0) at which a matched string stands, by tag and string in their order."""

    def places(m: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), F.replace(m["match"], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        parts = F.split(c, quoted)
        before = F.transform(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), F.length)
        width = F.length(m["match"])
        starts = F.transform(before, lambda _, i: F.aggregate(F.slice(before, F.lit(1), i + 1), F.lit(0), lambda a, n: a + n) + i * width)
        return F.transform(starts, lambda s: F.struct(m["tag"].alias("tag"), m["match"].alias("match"), s.alias("start"), (s + width).alias("end")))

    return F.flatten(F.transform(F.array_distinct(found), places))


def redact(c: Column, found: Column) -> Column:
    """The text with every occurrence of every matched string replaced by its tag."""
    return F.aggregate(found, c, lambda t, m: F.replace(t, m["match"], F.concat(F.lit("PI:"), m["tag"])))


def run_pii(df: DataFrame, text: str = "text", tags=ACTIVE) -> DataFrame:
    """df with text redacted, old_text, modified, and regex_metadata (the matches and where they stand in old_text, as JSON)."""
    found = df.withColumn("__found", detect(F.col(text), tags)).withColumnRenamed(text, "old_text")
    out = found.withColumn(text, redact(F.col("old_text"), F.col("__found")))
    out = out.withColumn("modified", ~F.col("old_text").eqNullSafe(F.col(text))).withColumn("regex_metadata", F.to_json(spans(F.col("old_text"), F.col("__found"))))
    return out.drop("__found")


def only_modified(df: DataFrame) -> DataFrame:
    """Rows that a redaction changed."""
    return df.where("modified")


def anonymize(c: Column, rules: dict[str, str], condition: Column | None = None) -> Column:
    """Own rules: each match becomes `` <TAG> `` where the condition holds; without a condition nothing is replaced."""
    if condition is None:
        return c
    return F.when(condition, reduce(lambda x, r: F.regexp_replace(x, r[1], f" <{r[0]}> "), rules.items(), c)).otherwise(c)
