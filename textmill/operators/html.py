"""Text, metadata and links of HTML pages.

The tree walk has no form in SQL, so it is one Arrow-batched function; what a
regular expression can say (language, title, links) stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROPPED = frozenset("script style header iframe footer form".split())
SHORT = frozenset("body div p section table ul ol dl".split())
SHORT_CHARS = 64
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FIELDS = {
    "text": "string",
    "metadata_html": "array<struct<char_start_idx:bigint,char_end_idx:bigint,key:string,type:string,value:string>>",
    "html_head": "array<string>",
    "html_footer": "array<string>",
    "html_title": "array<string>",
    "html_error": "int",
    "html_comment": "string",
}


class _Tree(HTMLParser):
    """Nodes are [tag, attributes, children]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ["", {}, []]
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li") and self.stack[-1][0] == tag:
            self.stack.pop()
        node = [tag, dict(attrs), []]
        self.stack[-1][2].append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1][2].append([tag, dict(attrs), []])

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.stack[-1][2].append(data)


def _plain(node) -> str:
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        else:
            todo += reversed(n[2])
    return "".join(out)


def extract(html: str) -> dict:
    """Text with line breaks for blocks, and where each kept element's text lies in it."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    found: dict[str, list[str]] = {"head": [], "footer": [], "title": []}
    text: list[str] = []
    size, meta = 0, []
    todo: list = [("node", tree.root)]
    while todo:
        kind, x = todo.pop()
        if kind == "close":
            start, tag, attrs = x
            if size > start:
                meta.append({"char_start_idx": start, "char_end_idx": size, "key": "html_tag", "type": "local", "value": tag})
            if tag in SHORT and text and not text[-1].endswith("\n"):
                text.append("\n")
                size += 1
            continue
        if isinstance(x, str):
            text.append(x)
            size += len(x)
            continue
        tag = x[0]
        if tag in ("head", "footer", "title"):
            found[tag].append(_plain(x).strip())
        if tag == "head":
            todo += [("node", c) for c in reversed(x[2]) if not isinstance(c, str) and c[0] == "title"]
            continue
        if tag == "title" or tag in DROPPED:
            continue
        if tag == "br":
            text.append("\n")
            size += 1
            continue
        if tag in SHORT and tag != "body" and len(_plain(x).strip()) <= SHORT_CHARS:
            continue
        while tag == "div" and len(x[2]) == 1 and not isinstance(x[2][0], str) and x[2][0][0] == "div":
            x = x[2][0]  # divs that hold nothing but a div fold
        if tag:
            todo.append(("close", (size, tag, x[1])))
        todo += [("node", c) for c in reversed(x[2])]
    return {"text": "".join(text).strip("\n"), "metadata_html": meta, "html_head": found["head"], "html_footer": found["footer"], "html_title": found["title"], "html_error": 0, "html_comment": ""}


def guarded(f: Callable[[str], dict]) -> Callable[[str], dict]:
    """An error in one row gives that row's defaults and a message, and spares the others."""

    def run(x: str) -> dict:
        try:
            return f(x)
        except Exception as e:  # noqa: BLE001 - the point is that no page ends the job
            return {"text": "", "metadata_html": [], "html_head": [], "html_footer": [], "html_title": [], "html_error": 1, "html_comment": f"{type(e).__name__}: {e}"[:500]}

    return run


def with_text(df: DataFrame, html: str = "html") -> DataFrame:
    """df with what extract finds, after the columns it has; they may not clash."""
    names = list(_FIELDS)
    clash = set(names) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    one = guarded(extract)

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in _FIELDS.items()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([one(h or "") for h in b], columns=names)

    return df.withColumn("__x", run(F.col(html))).select(*df.columns, "__x.*")


def html_lang(html: Column, text: Column | None = None) -> Column:
    """The lang attribute of the root; null where it is missing, or the text is empty."""
    found = F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", 1)
    found = F.nullif(found, F.lit(""))
    return found if text is None else F.when(text != "", found)


def title(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def links(html: Column) -> Column:
    """Targets of all anchors, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*\bhref\s*=\s*[\"']([^\"'>]*)[\"']"), 1))


def external_links(html: Column, domain: Column) -> Column:
    """Absolute links that don't hold the domain."""
    return F.filter(links(html), lambda x: x.rlike("^(?i)https?://") & ~F.contains(x, domain))


def outgoing_links(html: Column, domain: Column, mime: Column, kinds=("text/html",)) -> Column:
    """external_links of pages of some kinds, an empty list for others."""
    return F.when(mime.isin(*kinds), external_links(html, domain)).otherwise(F.array().cast("array<string>"))
