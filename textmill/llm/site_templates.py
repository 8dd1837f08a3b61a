"""HTML extraction without site templates.

Every element of a page is hashed with what it holds (tag, attributes, texts and
child elements).  Spark counts on how many pages of a host each hash occurs; an
element that recurs on many pages of its host is template, and its subtree is
deleted before the text is taken.

What decides is a number of pages, the same at every size of host: a block of one
section of a large host is template as it would be on a small one.  So a host may
have many templates, and no list of them is made: a page has a key, the buckets
that count a host's subtrees give back the keys of the pages that have a
template, and a page is joined to the hashes of its own templates only.

Defined results: a null or empty page, and one without markup, gives its text as
it is (null: empty); a null URL, or one without a host, counts as one host;
repeated rows are pages each, and equal pages of a host are not template as a
whole: html, head and body are never deleted.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host
from . import words as W
from .exchange import binary, blobs, bucket, buckets, cut

LEAST_PAGES = 5
#: Occurrences that a worker gathers before it sends them to the buckets.
_HELD = 1 << 20

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "noscript", "template")}
_HIDDEN = frozenset(("script", "style", "head", "template", "noscript"))
_BLOCK = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())
#: Elements whose start ends an open element of the same or another name.
_ENDS = {"li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_NEVER = frozenset(("#", "html", "head", "body"))


class Element:
    __slots__ = ("tag", "attrs", "children", "hash")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.children, self.hash = tag, attrs, [], 0


def parse(html: str) -> Element:
    """A forgiving tree: unclosed elements end where their parent does, stray ends are ignored."""
    root = Element("#", "")
    stack, names, at = [root], Counter(), 0
    for m in iter(_marks(html), None):
        begin, end, slash, tag, attrs = m
        if begin > at:
            stack[-1].children.append(html[at:begin])
        at = end
        if tag is None:
            continue
        if slash:
            if names[tag]:
                while True:
                    top = stack.pop()
                    names[top.tag] -= 1
                    if top.tag == tag:
                        break
            continue
        ends = {"p"} if tag in _BLOCK and tag != "br" else _ENDS.get(tag, ())
        if tag in _ENDS:
            ends = _ENDS[tag]
        if len(stack) > 1 and stack[-1].tag in ends:
            names[stack.pop().tag] -= 1
            if tag == "tr" and len(stack) > 1 and stack[-1].tag == "tr":
                names[stack.pop().tag] -= 1
        e = Element(tag, _SPACE.sub(" ", attrs.rstrip("/")).strip())
        stack[-1].children.append(e)
        if tag in _VOID or attrs.endswith("/"):
            continue
        stack.append(e)
        names[tag] += 1
    if at < len(html):
        stack[-1].children.append(html[at:])
    return root


def _marks(html: str):
    """A function that gives the next mark, skipping what raw elements hold."""
    at = 0

    def next_mark():
        nonlocal at
        m = _MARK.search(html, at)
        if m is None:
            return None
        tag = m.group(2)
        at = m.end()
        if tag is None:
            return m.start(), at, "", None, ""
        tag = tag.lower()
        if tag in _RAW and not m.group(1):
            close = _RAW[tag].search(html, at)
            begin, at = m.start(), (close.end() if close else len(html))
            return begin, at, "", None, ""  # what it holds is not text
        return m.start(), at, m.group(1), tag, m.group(3)

    return next_mark


def digest(root: Element) -> list[Element]:
    """All elements, children before parents, with their hashes (no recursion: pages may nest deeply)."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += [c for c in e.children if not isinstance(c, str)]
    order.reverse()
    for e in order:
        parts = [e.tag, e.attrs]
        for c in e.children:
            if isinstance(c, str):
                c = _SPACE.sub(" ", c).strip()
                if c:
                    parts.append("t" + c)
            else:
                parts.append(f"e{c.hash:x}")
        e.hash = xxhash.xxh64_intdigest("\0".join(parts)) if len(parts) > 2 else 0  # 0: holds nothing
    return order


def text_of(root: Element, template: frozenset = frozenset()) -> tuple[str, int]:
    """The text without the template's subtrees, and how many of those there were."""
    out, removed, todo = [], 0, [root]
    while todo:
        e = todo.pop()
        if isinstance(e, str):
            out.append(_SPACE.sub(" ", unescape(e)) if e else "\n")
            continue
        if e.tag in _HIDDEN:
            continue
        if e.hash in template and e.tag not in _NEVER:
            removed += 1
            continue
        if e.tag in _BLOCK:
            todo.append("")
            todo += reversed(e.children)
            out.append("\n")
        else:
            todo += reversed(e.children)
    lines = (_SPACE.sub(" ", x).strip() for x in "".join(out).split("\n"))
    return "\n".join(x for x in lines if x), removed


def _own(host: str) -> int:
    """What the hashes of a host are marked with, so that one number is host and subtree."""
    return xxhash.xxh64_intdigest(host)


def _send(many: int):
    """Each occurrence of a subtree on a page to the bucket of its mark, with the page's key."""

    def rows(held):
        mark, key, least = (np.concatenate(x) for x in zip(*held))
        at = bucket(mark, many)
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(many + 1))
        used = np.flatnonzero(np.diff(ends))
        body = [[binary(x[order[ends[k] : ends[k + 1]]]) for k in used] for x in (mark, key, least)]
        return pa.record_batch([pa.array(used, pa.int64()), *(pa.array(x, pa.binary()) for x in body)], ["bucket", "mark", "key", "least"])

    def run(batches):
        held, n = [], 0
        for chunk in W.chunks(batches, "html"):
            marks, per = [], []
            for at, html in zip(chunk.column("host").to_pylist(), chunk.column("html").to_pylist()):
                own = _own(at)
                found = {e.hash ^ own for e in digest(parse(html or "")) if e.hash and e.tag not in _NEVER}
                marks += found
                per.append(len(found))
            if marks:
                held.append([np.array(marks, np.uint64), *(np.repeat(chunk.column(c).to_numpy(zero_copy_only=False).astype(t), per) for c, t in (("key", np.int64), ("least", np.uint32)))])
                n += len(marks)
            if n >= _HELD:
                yield rows(held)
                held, n = [], 0
        if n:
            yield rows(held)

    return run


def _decide(t: pa.Table) -> pa.Table:
    """Of one bucket: (key, mark) of every page that has a subtree which is template."""
    mark, key, least = (np.concatenate(blobs(t[c], kind)) for c, kind in (("mark", np.uint64), ("key", np.int64), ("least", np.uint32)))
    order = np.lexsort((key, mark))
    mark, key, least = mark[order], key[order], least[order]
    new = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))
    pages = np.diff(np.append(new, len(mark)))
    keep = np.repeat(pages >= least[new], pages)
    keep[1:] &= (mark[1:] != mark[:-1]) | (key[1:] != key[:-1])  # pages that are equal share a key
    return pa.table({"key": key[keep], "mark": mark[keep].view(np.int64)})


def _strip(batches):
    for chunk in W.chunks(batches, "html"):
        out = []
        for html, host, template in zip(*(chunk.column(c).to_pylist() for c in ("html", "host", "template"))):
            root, own = parse(html or ""), _own(host)
            if template:
                digest(root)
            out.append(text_of(root, frozenset(h & W._M ^ own for h in template or ())))
        yield pa.record_batch([chunk.column("page_id"), chunk.column("host"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], ["page_id", "host", "text", "removed"])


def site_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = 0.0, id_col: str = "page_id") -> DataFrame:
    """(page_id, host, text, removed) of every page.

    A subtree on ``least_pages`` pages of its host or more is template; removed
    counts the deleted subtrees.  Callers may ask for a share of the host's pages
    as well, which makes large hosts keep most of theirs.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host(F.col("url")), F.lit("")).alias("host"), F.col("html").cast("string").alias("html")).withColumn("key", F.xxhash64("host", "html"))
    least = own.withColumn("least", F.lit(least_pages).cast("bigint"))
    if least_share > 0:
        totals = own.groupBy("host").agg(F.count("*").alias("total"))
        least = own.join(totals, "host").withColumn("least", F.greatest(F.lit(least_pages), F.ceil(least_share * F.col("total"))).cast("bigint"))
    sent = least.select("host", "html", "key", "least").mapInArrow(_send(buckets(pages.sparkSession)), "bucket bigint, mark binary, key binary, least binary")
    found = sent.groupBy("bucket").applyInArrow(_decide, "key bigint, mark bigint")
    templates = cut(found.groupBy("key").agg(F.collect_list("mark").alias("template")))  # the occurrences are let go before pages are joined
    kind = own.schema["page_id"].dataType.simpleString()
    return own.join(templates, "key", "left").select("page_id", "host", "html", "template").mapInArrow(_strip, f"page_id {kind}, host string, text string, removed bigint")
