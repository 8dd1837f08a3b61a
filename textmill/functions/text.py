"""Column functions over text; all run inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spaces that count as the plain one.
WIDE_SPACES = "".join(map(chr, (0x20, 0x2009, 0x200A, 0x202F, 0x2005, 0x3000, 0x2002, 0xA0, 0x2008, 0x2003, 0xFFFC, 0x84)))
#: Characters that carry no word: ASCII marks, digits, white space, and common signs and pictographs.
SIGNS = "«»‹›„“”‘’‚‛‟…–—―‐‑‒•·°©®™§¶†‡¡¿¢£¤¥€¦¨¬¯±²³´µ¸¹º¼½¾×÷←↑→↓↔⇒∀∂∃∅∆∇∈∏∑−√∞∧∨∩∪∫≈≠≡≤≥⊂⊃■□▪▲►▼◄◆○●★☆☎☺♀♂♠♣♥♦♪✓✔✗✦❤➔😀😁😂😃😄😅😆😉😊😍😎😘😢😭😡👍👎👏🙏🎉🔥💯"
SPECIAL = "".join(dict.fromkeys(string.punctuation + string.digits + " \t\n\r\x0b\x0c" + WIDE_SPACES + SIGNS))

#: Punctuation of other scripts and its plain form.  The full-width digit one stands for a quotation mark.
PLAIN_MARKS = {
    "，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"', "《": '"', "》": '"',
    "´": "'", "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-", "—": " - ", "．": ". ", "～": "~", "’": "'",
    "…": "...", "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]", "％": "%", "►": "-",
}


def lit_sql(s: str) -> str:
    """A SQL string literal of s."""
    return "'" + s.replace("'", "''") + "'"


def unicode_strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def uniform_spaces(c: Column) -> Column:
    return F.translate(c, WIDE_SPACES, " " * len(WIDE_SPACES))


def drop_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x1F\x7F-\x9F]", "")


def plain_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\d", "0")


def plain_marks(c: Column) -> Column:
    one = {k: v for k, v in PLAIN_MARKS.items() if len(v) == 1}
    c = F.translate(c, "".join(one), "".join(one.values()))
    for k, v in PLAIN_MARKS.items():
        if len(v) > 1:
            c = F.replace(c, F.lit(k), F.lit(v))
    return c


def normalize(c: Column, control: bool = True, strip: bool = True, lower: bool = True, spaces: bool = True, digits: bool = True, marks: bool = True) -> Column:
    """The steps in their fixed order; each can be switched off."""
    for on, f in ((control, drop_control), (strip, unicode_strip), (lower, F.lower), (spaces, uniform_spaces), (digits, plain_digits), (marks, plain_marks)):
        c = f(c) if on else c
    return c


def strip_special(c: Column) -> Column:
    return F.btrim(c, F.lit(SPECIAL))


def split_words(c: Column, newline: bool = True, tab: bool = True) -> Column:
    """Runs between blanks (and newlines, tabs); no other white space separates."""
    return F.filter(F.split(c, "[ " + "\\n" * newline + "\\t" * tab + "]"), lambda x: x != "")


def words(c: Column, lower: bool = True, strip: bool = True) -> Column:
    w = split_words(c)
    if lower:
        w = F.transform(w, F.lower)
    if strip:
        w = F.transform(w, strip_special)
    return F.filter(w, lambda x: x != "")


def word_ngrams(w: Column, n: int, join: str = " ") -> Column:
    """All runs of n words, joined; none if there are fewer."""
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), join))).otherwise(F.array().cast("array<string>"))


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def special_ratio(c: Column) -> Column:
    return ratio(F.length(c) - F.length(F.translate(c, SPECIAL, "")), F.length(c))


def member_ratio(w: Column, members: Column) -> Column:
    """Share of words in an array of words, at most 1."""
    return F.least(ratio(F.size(F.filter(w, lambda x: F.array_contains(members, x))), F.size(w)), F.lit(1.0))
