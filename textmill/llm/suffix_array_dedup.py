"""Passages of L words or more that the corpus has twice: a suffix array refined by bucket pointers.

Suffixes are word positions.  They start in the bucket of their first q words,
and a bucket is refined by sorting its suffixes on the bucket identifiers of
the positions as far on as the depth sorted so far; the new identifiers are
what the next refinement sorts on, so q becomes 2q, 4q and so on up to L.  A
suffix alone in its bucket repeats nothing and is dropped at once.

Most suffixes never get a bucket.  A window of L words holds L - q + 1 q-grams,
and the least of their hashes is the window's anchor; equal windows have equal
anchors.  Only the anchors are sent first, and only the windows around anchors
that occur twice are sorted, so nothing that repeats is missed.

An identifier is the number of the task that owns a range of buckets, followed
by the rank in that range: identifiers are in suffix-array order, and a
refinement stays in its task.  Chunks send each distinct pair of identifiers
once, so a passage in every document costs a row for each chunk only.

Of the windows with equal words the first by (doc_id, position) stays, the
others go.  Within one document a window that overlaps its own first occurrence
gives up only what lies beyond it.

Defined results: a null or empty text, and one of fewer than L words, repeats
nothing; a null id comes after all others; rows of equal id and text are one
document, which they share the cuts of.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .exchange import binary, blobs, bucket, buckets, chunk_ids, cut, fresh, list_array, pack6, release, tidy, tidy_groups, unpack6

LENGTH, Q = 50, 12
_TOP = np.uint64(W._M)
_LAST = np.iinfo(np.int64).max
_TWICE = np.int64(1 << 62)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (no heed to where documents end)."""
    out = np.full(len(h), _TOP)
    if len(h) >= n:
        sums = W.power_sums(h)
        out[: len(h) - n + 1] = W.mix(W.unpowered(sums[n:] - sums[:-n], np.arange(len(h) - n + 1)))
    return out


def sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f (minimum or maximum) over x[i : i + w], for the i where that fits."""
    width = 1
    while 2 * width <= w:
        x = f(x[:-width], x[width:])
        width *= 2
    return f(x[: len(x) - (w - width)], x[w - width :]) if w > width else x


def anchors(g: np.ndarray, woff: np.ndarray, length: int, q: int) -> np.ndarray:
    """Positions whose q-gram is the least of some window of a document."""
    many = length - q + 1
    if len(g) < length:
        return np.zeros(0, np.int64)
    start = np.arange(len(g) - length + 1)
    fits = start + length <= np.repeat(woff[1:], np.diff(woff))[: len(start)]
    least = np.where(fits, sliding(g[: len(g) - q + 1], many, np.minimum), np.uint64(0))
    pad = np.zeros(many - 1, np.uint64)
    best = sliding(np.concatenate([pad, least, pad]), many, np.maximum)
    return np.flatnonzero((best == g[: len(best)]) & (best > 0))


def _unique(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    u, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return u, inverse, np.minimum(count, 2).astype(np.uint8)


def _planes(x: np.ndarray, rising: bool = True) -> bytes:
    """Numbers as bytes of one weight after another, as differences where they mostly rise: what compression makes small."""
    x = np.diff(x, prepend=x.dtype.type(0)) if rising else np.ascontiguousarray(x)
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _numbers(b: bytes, kind, rising: bool = True) -> np.ndarray:
    x = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(x, dtype=kind) if rising else x


def _packed(c: int, b: np.ndarray, many: int, *columns: np.ndarray):
    """A row for each bucket of columns sorted by bucket."""
    to = np.searchsorted(b, np.arange(many + 1))
    used = [k for k in range(many) if to[k] < to[k + 1]]
    return [pa.array(used, pa.int64()), pa.array([c] * len(used), pa.int64()), *(pa.array([binary(x[to[k] : to[k + 1]]) for k in used], pa.binary()) for x in columns)]


def _send_anchors(length: int, q: int, many: int):
    def run(batches):
        ids = chunk_ids()
        for chunk in W.chunks(batches):
            c = next(ids)
            h, _, _, woff = W.words(chunk.column("text"), lower=False)
            g = grams(h, q)
            at = anchors(g, woff, length, q)
            u, inverse, count = _unique(g[at])
            doc = np.searchsorted(woff, at, "right") - 1
            head = pa.record_batch([pa.array([many + c % many]), pa.array([c]), pa.array([binary(chunk.column("key").to_numpy())]), pa.array([binary(np.stack([doc, at - woff[doc], inverse]))])], ["bucket", "chunk", "a", "b"])
            if len(at):
                yield head
                yield pa.record_batch(_packed(c, bucket(u, many), many, u, count), ["bucket", "chunk", "a", "b"])

    return run


HEAD = "bucket bigint, chunk bigint, a binary, b binary"
BACK = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


def _repeated_anchors(many: int):
    """Of one bucket: for each chunk, which of its hashes occur twice in the corpus."""

    def run(t: pa.Table) -> pa.Table:
        if t["bucket"][0].as_py() >= many:
            return t.cast(BACK)
        hs = blobs(t["a"], np.uint64)
        u, inverse = np.unique(np.concatenate(hs), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(blobs(t["b"], np.uint8)), len(u))
        good = np.split((total > 1)[inverse], np.cumsum([len(x) for x in hs])[:-1])
        return pa.table([t["bucket"], t["chunk"], pa.array([b""] * len(hs), pa.binary()), pa.array([binary(x.astype(np.uint8)) for x in good], pa.binary())], schema=BACK)

    return run


def _marks(many: int):
    """Of one chunk: the documents with repeated anchors and where those are."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("bucket")
        keys, (doc, at, inverse) = np.frombuffer(t["a"][-1].as_py(), np.int64), np.frombuffer(t["b"][-1].as_py(), np.int64).reshape(3, -1)
        good = np.concatenate(blobs(t["b"].slice(0, t.num_rows - 1), np.uint8)).astype(bool)[inverse]
        doc, at = doc[good], at[good]
        which, first = np.unique(doc, return_index=True)
        return pa.table({"key": keys[which], "at": list_array(at, np.append(first, len(at)), pa.int32())})

    return run


def _state(length: int, q: int):
    """Per chunk of marked documents: every window around a repeated anchor, and the q-grams its refinement reads."""

    def run(batches):
        ids = chunk_ids()
        for chunk in W.chunks(batches):
            h, start, end, woff = W.words(chunk.column("text"), lower=False)
            g = grams(h, q)
            lists = chunk.column("at")
            at = lists.flatten().to_numpy().astype(np.int64) + np.repeat(woff[:-1], pc.list_value_length(lists).to_numpy())
            last = np.repeat(woff[1:], np.diff(woff)) - length
            first = np.repeat(woff[:-1], np.diff(woff))
            change = np.zeros(len(h) + 1, np.int32)
            lo, hi = np.maximum(at - (length - q), first[at]), np.minimum(at, last[at])
            np.add.at(change, lo, 1)
            np.add.at(change, hi + 1, -1)
            window = np.cumsum(change[:-1]) > 0
            need, depth = window.copy(), q
            while depth < length:  # offsets that the refinements look at
                step = min(depth, length - depth)
                more = need.copy()
                more[step:] |= need[:-step]
                need, depth = more, depth + step
            pos = np.flatnonzero(need)
            doc = np.searchsorted(woff, pos, "right") - 1
            _, doff = W.utf8(chunk.column("text"))
            tail = end[np.minimum(pos + length - 1, len(h) - 1)]
            yield pa.record_batch(
                [pa.array([next(ids)])]
                + [pa.array([binary(x)], pa.binary()) for x in (pc.fill_null(chunk.column("doc_id"), _LAST).to_numpy(), chunk.column("key").to_numpy())]
                + [pa.array([_planes(x.astype(np.int32))], pa.binary()) for x in (doc, pos - woff[doc])]
                + [pa.array([binary(window[pos].astype(np.uint8))], pa.binary())]
                + [pa.array([_planes(x.astype(np.int32))], pa.binary()) for x in (start[pos] - doff[doc], tail - doff[doc])]
                + [pa.array([_planes(g[pos], False)], pa.binary())],
                ["chunk", "ids", "keys", "doc", "pos", "window", "from", "to", "b"],
            )

    return run


STATE = "chunk bigint, ids binary, keys binary, doc binary, pos binary, window binary, from binary, to binary, b binary"


class _Chunk:
    """The state row of a chunk as arrays."""

    def __init__(self, row: dict):
        self.row, self.c = row, row["chunk"]
        self.ids, self.keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
        self.doc, self.pos = _numbers(row["doc"], np.int32), _numbers(row["pos"], np.int32)
        self.window, self.b = np.frombuffer(row["window"], np.uint8).astype(bool), _numbers(row["b"], np.uint64, False)

    def ahead(self, step: int) -> np.ndarray:
        """Bucket identifier of the position ``step`` words on; 0 where that has none."""
        place = self.doc.astype(np.int64) << 32 | self.pos
        at = np.minimum(np.searchsorted(place, place + step), max(len(place) - 1, 0))
        return np.where(place[at] == place + step, self.b[at], np.uint64(0)) if len(place) else self.b

    def pairs(self, step: int):
        """(first, second) of each distinct pair of identifiers in order, the places with a pair, and each one's rank."""
        second = self.ahead(step)
        live = np.flatnonzero((self.b > 0) & (second > 0))
        order = live[np.lexsort((self.pos[live], self.doc[live], second[live], self.b[live]))]
        x, y = self.b[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        return x[new], y[new], order, np.cumsum(new) - 1, new


def _send_first(many: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = _Chunk(row)
                u, _, count = _unique(s.b)
                b = bucket(u, many)
                rows = _packed(s.c, b, many, u, count)
                rows[2] = pa.array([pack6(x) for x in blobs(rows[2], np.uint64)], pa.binary())
                yield pa.record_batch(rows, ["bucket", "chunk", "a", "b"])

    return run


def _name_first(t: pa.Table) -> pa.Table:
    """Of one bucket range: ranks in hash order, from 1; 0 for a q-gram that occurs once."""
    hs = [unpack6(x) for x in blobs(t["a"], np.uint8)]
    u, inverse = np.unique(np.concatenate(hs), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(blobs(t["b"], np.uint8)), len(u))
    rank = np.where(total > 1, np.arange(1, len(u) + 1), 0).astype(np.uint32)[inverse]
    parts = np.split(rank, np.cumsum([len(x) for x in hs])[:-1])
    return pa.table([t["bucket"], t["chunk"], pa.array([binary(x) for x in parts], pa.binary()), pa.array([b""] * len(hs), pa.binary())], schema=BACK)


def _names(back: pa.Table) -> np.ndarray:
    """Identifiers of the buckets of a chunk's distinct keys, in their order: range and rank, 0 for none."""
    parts = [np.where(r > 0, (np.uint64(k) << np.uint64(40)) + r.astype(np.uint64), np.uint64(0)) for k, r in zip(back["bucket"].to_pylist(), blobs(back["a"], np.uint32))]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _send_pairs(step: int, many: int, last: bool):
    """Distinct pairs of identifiers by range; with the last refinement each says who is its chunk's first, before that only whether the chunk has it twice."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = _Chunk(row)
                x, y, order, rank, new = s.pairs(step)
                if not len(x):
                    continue
                # The range is the row's; the rank in it and the identifier ahead make the key.
                key = np.stack([x & np.uint64((1 << 40) - 1), y & np.uint64(0xFFFFFFFF), y >> np.uint64(32)], 1).astype(np.uint32)
                if not last:
                    yield pa.record_batch(_packed(s.c, (x >> np.uint64(40)).astype(np.int64), many, key, (np.bincount(rank) > 1).astype(np.uint8)), ["bucket", "chunk", "a", "b"])
                    continue
                # The first by (doc_id, chunk, document, position) speaks for the chunk.
                by = np.lexsort((s.pos[order], s.doc[order], s.ids[s.doc[order]], rank))
                lead = order[by[new]]
                place = s.doc[lead].astype(np.int64) << 32 | s.pos[lead]
                who = np.stack([s.ids[s.doc[lead]], place | (np.bincount(rank) > 1).astype(np.int64) * _TWICE], 1)
                yield pa.record_batch(_packed(s.c, (x >> np.uint64(40)).astype(np.int64), many, key, who), ["bucket", "chunk", "a", "b"])

    return run


def _rank(t: pa.Table) -> pa.Table:
    """Sort one range on (identifier, identifier ahead): new ranks, 0 for a pair that occurs once."""
    parts = [x.reshape(-1, 3) for x in blobs(t["a"], np.uint32)]
    key = np.concatenate(parts).astype(np.uint64)
    x, y = key[:, 0], key[:, 1] | key[:, 2] << np.uint64(32)
    del key
    order = np.lexsort((y, x))
    new = np.ones(len(order), bool)
    new[1:] = (x[order[1:]] != x[order[:-1]]) | (y[order[1:]] != y[order[:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group, 1 + np.concatenate(blobs(t["b"], np.uint8))[order])
    back = np.zeros(len(order), np.uint32)
    back[order] = np.where(many > 1, np.arange(1, len(many) + 1), 0).astype(np.uint32)[group]
    cuts = np.cumsum([len(x) for x in parts])[:-1]
    return pa.table([t["bucket"], t["chunk"], pa.array([binary(x) for x in np.split(back, cuts)], pa.binary()), pa.array([b""] * t.num_rows, pa.binary())], schema=BACK)


def _refine(t: pa.Table) -> pa.Table:
    """Sort one range on (identifier, identifier ahead); new ranks and each bucket's first suffix as (chunk, place)."""
    parts = [x.reshape(-1, 3) for x in blobs(t["a"], np.uint32)]
    key = np.concatenate(parts).astype(np.uint64)
    x, y = key[:, 0], key[:, 1] | key[:, 2] << np.uint64(32)
    who = np.concatenate([x.reshape(-1, 2) for x in blobs(t["b"], np.int64)])
    place, twice = who[:, 1] & ~_TWICE, (who[:, 1] & _TWICE) > 0
    chunk = np.repeat(t["chunk"].to_numpy(), [len(x) for x in parts])
    order = np.lexsort((place, chunk, who[:, 0], y, x))
    new = np.ones(len(order), bool)
    new[1:] = (x[order[1:]] != x[order[:-1]]) | (y[order[1:]] != y[order[:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group, 1 + twice[order])
    rank = np.where(many > 1, np.arange(1, len(many) + 1), 0).astype(np.uint32)
    lead = order[new][group]
    back, out = np.zeros(len(order), np.uint32), np.zeros((len(order), 2), np.int64)
    back[order] = rank[group]
    out[order] = np.where(rank[group, None] > 0, np.stack([chunk[lead], place[lead]], 1), 0)
    cuts = np.cumsum([len(x) for x in parts])[:-1]
    return pa.table([t["bucket"], t["chunk"], pa.array([binary(x) for x in np.split(back, cuts)], pa.binary()), pa.array([binary(x) for x in np.split(out, cuts)], pa.binary())], schema=BACK)


_FIELDS = ["ids", "keys", "doc", "pos", "window", "from", "to", "b"]


def _take_names(step: int):
    """The state of a chunk with the names that came back."""

    def run(state: pa.Table, back: pa.Table) -> pa.Table:
        if not state.num_rows:
            return pa.schema([("chunk", pa.int64()), *((f, pa.binary()) for f in _FIELDS)]).empty_table()
        row = state.to_pylist()[0]
        s, back = _Chunk(row), back.sort_by("bucket")
        names = _names(back)
        b = np.zeros(len(s.b), np.uint64)
        if not step:
            b = names[_unique(s.b)[1]] if len(names) else b
        elif len(names):
            _, _, order, rank, _ = s.pairs(step)
            b[order] = names[rank]
        keep = b > 0
        row |= {f: _planes(_numbers(row[f], np.int32)[keep]) for f in ("doc", "pos", "from", "to")} | {"window": binary(s.window[keep].astype(np.uint8)), "b": _planes(b[keep], False)}
        return pa.table({"chunk": [row["chunk"]], **{f: pa.array([row[f]], pa.binary()) for f in _FIELDS}})

    return run


SPAN = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("start_byte", pa.int64()), ("end_byte", pa.int64()), ("kept", pa.bool_())])


def _spans(step: int, length: int):
    """Of one chunk: runs of words that are a first occurrence, and runs that repeat one."""

    def run(state: pa.Table, back: pa.Table) -> pa.Table:
        if not state.num_rows or not back.num_rows:
            return SPAN.empty_table()
        row, back = state.to_pylist()[0], back.sort_by("bucket")
        s = _Chunk(row)
        names, lead = _names(back), np.concatenate(blobs(back["b"], np.int64)).reshape(-1, 2)
        _, _, order, rank, _ = s.pairs(step)
        ok = (names[rank] > 0) & s.window[order]
        at, lead = order[ok], lead[rank[ok]]
        by = np.argsort(at)
        at, lead = at[by], lead[by]
        doc, pos = s.doc[at].astype(np.int64), s.pos[at].astype(np.int64)
        begin, finish = _numbers(row["from"], np.int32), _numbers(row["to"], np.int32)
        home = (lead[:, 0] == s.c) & (lead[:, 1] >> 32 == doc)
        at_first = lead[:, 1] & 0xFFFFFFFF
        first = home & (at_first == pos)
        out = []
        for kept in (True, False):
            d, p, i, own = doc[first == kept], pos[first == kept], at[first == kept], np.where(home, at_first + length, 0)[first == kept]
            lo = p if kept else np.maximum(p, own)
            if not len(d):
                continue
            # In order of position the ends rise, so a run breaks where the next start lies beyond the last end.
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (lo[1:] > p[:-1] + length)
            a, z = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(d)) - 1
            # A run that starts past its window's first word starts where the first occurrence ended.
            cut_ = lo[a] != p[a]
            start = np.where(cut_, -1, begin[i[a]])
            if cut_.any():
                known = dict(zip(zip(doc.tolist(), pos.tolist()), finish[at].tolist()))
                for k in np.flatnonzero(cut_):
                    start[k] = known[int(d[a[k]]), int(lo[a[k]]) - length]
            ids = s.ids[d[a]]
            out.append(pa.table([s.keys[d[a]], pa.array(ids, mask=ids == _LAST), lo[a], p[z] + length, start, finish[i[z]], np.full(len(a), kept)], schema=SPAN))
        return pa.concat_tables(out) if out else SPAN.empty_table()

    return run


def _next(state: DataFrame, back: DataFrame, step: int) -> DataFrame:
    out = cut(state.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(tidy_groups(_take_names(step)), STATE))
    release(state)
    return out


def repeated_spans(df: DataFrame, length: int = LENGTH, q: int = Q, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, start_word, end_word, start_byte, end_byte, kept) of every repeated passage.

    key is a hash of (id, text); rows with the same key are one document.
    """
    if not 1 <= q <= length:
        raise ValueError("q must lie between 1 and length")
    spark = df.sparkSession
    many = buckets(spark)
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    sent = docs.mapInArrow(tidy(_send_anchors(length, q, many)), HEAD)
    marks = cut(sent.groupBy("bucket").applyInArrow(tidy_groups(_repeated_anchors(many)), HEAD).groupBy("chunk").applyInArrow(tidy_groups(_marks(many)), "key bigint, at array<int>"))
    marked = docs.join(marks.dropDuplicates(["key"]), "key").dropDuplicates(["key"])
    state = cut(marked.mapInArrow(tidy(_state(length, q)), STATE))
    release(marks)
    back = state.mapInArrow(tidy(_send_first(many)), HEAD).groupBy("bucket").applyInArrow(tidy_groups(_name_first), HEAD)
    state = _next(state, back, 0)
    depth = q
    while True:
        step = min(depth, length - depth)
        depth += step
        back = state.mapInArrow(tidy(_send_pairs(step, many, depth == length)), HEAD).groupBy("bucket").applyInArrow(tidy_groups(_refine if depth == length else _rank), HEAD)
        if depth == length:
            break
        state = _next(state, back, step)
    return state.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        tidy_groups(_spans(step, length)), "key bigint, doc_id bigint, start_word bigint, end_word bigint, start_byte bigint, end_byte bigint, kept boolean"
    )


def suffix_array_dedup(df: DataFrame, length: int = LENGTH, q: int = Q, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, kept) of every passage of ``length`` words or more that occurs twice.

    Rows with kept are the first occurrences, the others repeat one; end_word is
    the word after the last.
    """
    return repeated_spans(df, length, q, id_col, text_col).select("doc_id", "start_word", "end_word", "kept")


def _cut_out(names: list[str], text_col: str, spans_col: str):
    def run(batches):
        for batch in W.chunks(batches, text_col):
            text = batch.column(text_col).to_pylist()
            for i, spans in enumerate(batch.column(spans_col).to_pylist()):
                if spans:
                    raw = text[i].encode()
                    for a, z in sorted(((x["start_byte"], x["end_byte"]) for x in spans), reverse=True):
                        raw = raw[:a] + raw[z:]
                    text[i] = raw.decode()
            yield pa.record_batch([pa.array(text, pa.string()) if n == text_col else batch.column(n) for n in names], names)

    return run


def drop_repeats(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """docs whose repeated passages are cut out of all but their first document; n_chars is counted anew.

    A document that is nothing but repeats stays, as a row of what is left of it.
    """
    key, spans = fresh(docs, "__key"), fresh(docs, "__spans")
    per = repeated_spans(docs, length, q).where("NOT kept").groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("start_byte", "end_byte")).alias(spans))
    wide = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text"))).join(cut(per), key, "left").select(*docs.columns, spans)
    out = wide.mapInArrow(tidy(_cut_out(docs.columns, "text", spans)), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
