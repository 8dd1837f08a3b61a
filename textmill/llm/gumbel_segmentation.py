"""Distinct sampled segmentations under a piece vocabulary: Gumbel top-k by perturbed A-star search.

A text is "▁" and the text with spaces as "▁"; every "▁" starts a unit, which no
piece of the vocabulary crosses, so the lattice of a text is the lattices of its
units in a row.  Backward sums give each edge its probability given that a path
reaches it: the search's bounds are exact, and following a node down is
sampling.

The search holds disjoint sets of segmentations with the largest perturbed
log-probability (log-probability plus Gumbel noise) of each, drawn as a
truncated Gumbel of the set's mass.  The set with the largest is followed down
to its best segmentation, the next sample, and what it leaves on the way (the
other edges at each step) becomes new sets.  k rounds give the k largest: k
distinct segmentations drawn without replacement, in order.  The largest value
left is the threshold for inclusion: a segmentation of log-probability l passes
it with probability 1 - exp(-exp(l - threshold)).

All documents of a chunk go through a round together, in numpy; the lattice of
a distinct unit is built once a chunk.  Random numbers come from a counter keyed
by (seed, id, text), so a row gives the same samples on any cluster.

Piece log-probabilities follow Zipf's law by the vocabulary's ranks, to the
power ``alpha``.  Characters without a piece fall back to bytes.

Defined results: a null text gives no rows; the empty one is the one piece "▁";
a text with fewer than k segmentations gives them all, each with log_inclusion
0; equal rows give equal samples.  A literal "▁" decodes to a space.  Other
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import units as U
from . import words as W

VOCABULARY, SAMPLES, ALPHA, SEED = "piece_bpe_32k.model", 2, 0.5, 17
CHUNK = 1_500_000  # bytes of text whose lattices are held at once; a longer document is one chunk
_STEPS = 8  # steps of a path that are sets of their own before the rest is one set
_BYTE0, _A, _C = 3, np.uint64(6364136223846793005), np.uint64(1442695040888963407)


class Pieces:
    """The vocabulary and all beginnings of its pieces as sorted hashes with log-probabilities; ids of mere beginnings are -1."""

    def __init__(self, path: str):
        sp = U.piece_encoder(path)
        names = [(sp.id_to_piece(i), i, sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        names = [(p, i, s) for p, i, s in names if "▁" not in p[1:] and (s > -1e8 or p == "▁")]
        self.longest = max(len(p) for p, _, _ in names)
        begun = list(dict.fromkeys([p for p, _, _ in names] + [p[:n] for p, _, _ in names for n in range(1, len(p))]))  # the pieces first
        blob, size = "".join(begun).encode(), np.array([len(p.encode()) for p in begun])
        end = np.cumsum(size)
        h = U.hashes(np.frombuffer(blob, np.uint8), end - size, end)
        rank = np.minimum([1 - s for _, _, s in names], len(names))  # the bare "▁" has no rank of its own: the last
        lp = -np.log(1 + rank)
        lp -= np.log(np.exp(lp).sum())
        self.unknown = float(lp.min()) - 10
        order, more = np.argsort(h), len(begun) - len(names)
        self.h, self.ids, self.lp = h[order], np.array([i for _, i, _ in names] + [-1] * more, np.int32)[order], np.append(lp, np.full(more, self.unknown))[order]
        # A table by the top bits leaves few places to look at, and none for most hashes.
        self.bits = 20
        self.first = np.searchsorted(self.h, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(self.h)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where no piece begins so."""
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        out = np.full(len(h), -1, np.int32)
        i = np.flatnonzero(at < end)
        while len(i):
            same = self.h[at[i]] == h[i]
            out[i[same]] = at[i[same]]
            at[i] += 1
            i = i[~same & (at[i] < end[i])]
        return out


class Lattice:
    """Edges of all distinct units of a chunk, by start node, longest first."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces, alpha: float):
        leads = (raw & 0xC0) != 0x80
        lead = np.flatnonzero(leads)
        before = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(leads, out=before[1:])
        a, z = before[start].astype(np.int64), before[end].astype(np.int64)
        many = z - a  # characters of each unit
        self.root = np.cumsum(many + 1) - (many + 1)
        nodes = int((many + 1).sum())
        char = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)).astype(np.int32)  # place in the unit
        at, left = np.repeat(a.astype(np.int32), many) + char, np.repeat(many.astype(np.int32), many) - char
        lead = np.append(lead, len(raw)).astype(np.int32 if len(raw) < 1 << 31 else np.int64)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * W._powers("r", W._R, len(raw))[: len(raw)], out=sums[1:])
        inv = W._powers("inv", W._R_INV, len(raw))
        begin, base = lead[at], np.repeat(self.root.astype(np.int32), many) + char
        head, hsum = inv[begin], sums[begin]
        src, dst, place = [], [], []
        i = np.arange(len(left))
        for n in range(1, pieces.longest + 1):
            i = i[left[i] >= n]
            if not len(i):
                break
            stop = lead[at[i] + n]
            p = pieces.find(W.mix((sums[stop] - hsum[i]) * head[i] + (stop - begin[i]).astype(np.uint64)))
            piece = pieces.ids[p] >= 0
            piece &= p >= 0
            if n == 1:  # a character always has an edge
                src.append(base[i])
                place.append(np.where(piece, p, -1))
            else:
                src.append(base[i[piece]])
                place.append(p[piece])
            dst.append(src[-1] + n)
            i = i[p >= 0]  # what no piece begins with has no longer pieces either
        del begin, head, hsum, left, char, sums
        src, dst, place = (np.concatenate(x[::-1]) if x else np.zeros(0, np.int32) for x in (src, dst, place))
        order = np.argsort(src, kind="stable")  # by start, longer pieces first: those are tried first
        src, dst, place = src[order], dst[order], place[order]
        lp = alpha * np.where(place >= 0, pieces.lp[place], pieces.unknown)
        # Backward sums, all units at once, from their ends.
        beta = np.full(nodes, -np.inf)
        beta[self.root + many] = 0.0
        from_end = (np.repeat(many + self.root, many + 1) - np.arange(nodes)).astype(np.int32)
        behind = from_end[src]
        order = np.argsort(behind.astype(np.uint16) if len(many) and many.max() < 65536 else behind, kind="stable").astype(np.int32)
        behind, by = behind[order], src[order]
        new = np.flatnonzero(np.append(True, by[1:] != by[:-1])) if len(by) else np.zeros(0, np.int64)  # one for each node
        group = np.searchsorted(behind[new], np.arange(1, int(many.max(initial=0)) + 2))
        new = np.append(new, len(by))
        lp_by, dst_by = lp[order], dst[order]
        del order, behind
        for lo, hi in zip(group[:-1].tolist(), group[1:].tolist()):
            if lo < hi:
                at_ = slice(int(new[lo]), int(new[hi]))
                starts = new[lo:hi] - new[lo]
                v = lp_by[at_] + beta[dst_by[at_]]
                top = np.maximum.reduceat(v, starts)
                beta[by[new[lo:hi]]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, np.diff(np.append(starts, len(v))))), starts))
        del lp_by, dst_by, new
        self.dst, self.lp = dst, lp + beta[dst] - beta[src]
        fan = np.bincount(src, minlength=nodes)
        self.first = np.concatenate([[0], np.cumsum(fan)]).astype(np.int32)
        self.ids = np.where(place >= 0, pieces.ids[place], -1)
        p = np.exp(self.lp)
        c = np.cumsum(p)
        self.inner = fan > 0  # not a unit's end
        head = self.first[:-1][self.inner]
        self.cum = c - np.repeat(c[head] - p[head], fan[self.inner])
        self.cum[self.first[1:][self.inner] - 1] = 2.0
        # Where the bytes of a character are that has no piece.
        self.lead, self.char = lead, np.zeros(nodes, np.int32)
        self.char[base] = at

    def node(self, edge: np.ndarray) -> np.ndarray:
        """The node that an edge starts from."""
        return np.searchsorted(self.first, edge.astype(np.int32), "right") - 1

    def descend(self, node: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample a path from each node to its unit's end: (edges, offsets)."""
        live, node, state = np.arange(len(node)), node.copy(), state.copy()
        many, steps = np.zeros(len(node), np.int64), []
        ok = self.inner[node]
        live, node, state = live[ok], node[ok], state[ok]
        while len(live):
            state = state * _A + _C
            u = (state >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = self.first[node]
            todo = np.flatnonzero(self.cum[e] < u)
            while len(todo):
                e[todo] += 1
                todo = todo[self.cum[e[todo]] < u[todo]]
            steps.append((live, e))
            many[live] += 1
            node = self.dst[e]
            ok = self.inner[node]
            live, node, state = live[ok], node[ok], state[ok]
        off = np.concatenate([[0], np.cumsum(many)])
        edges = np.zeros(off[-1], np.int32)
        for k, (i, e) in enumerate(steps):
            edges[off[i] + k] = e
        return edges, off


def _uniform(key: np.ndarray, count: int, salt: int) -> np.ndarray:
    """(len(key), count) numbers in (0, 1)."""
    x = W.mix(key[:, None] ^ W.mix(np.arange(count, dtype=np.uint64) + np.uint64(salt << 32))[None])
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _log1mexp(x: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)) for x <= 0."""
    with np.errstate(divide="ignore"):
        x = np.minimum(x, 0.0)
        return np.where(x > -0.693, np.log(-np.expm1(x)), np.log1p(-np.exp(x)))


def _truncated(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel variable of location ``mass``, given that it is below ``bound``."""
    with np.errstate(divide="ignore"):
        return np.where(np.isneginf(mass), -np.inf, -np.logaddexp(-bound, np.log(-np.log(u)) - mass))


class Search:
    """The k largest of each document of a chunk."""

    def __init__(self, lattice: Lattice, unit: np.ndarray, uoff: np.ndarray, key: np.ndarray):
        self.l, self.unit, self.uoff, self.key, self.docs = lattice, unit, uoff, key, len(key)
        self.local = np.arange(len(unit)) - np.repeat(uoff[:-1], np.diff(uoff))
        self.paths: list[list[np.ndarray]] = [[] for _ in key]
        self.values: list[list[tuple[float, float]]] = [[] for _ in key]
        self.open: list[list[tuple]] = [[] for _ in key]  # (value, round, step, last step or None, excluded edges)

    def _states(self, doc: np.ndarray, local: np.ndarray, r: int) -> np.ndarray:
        return W.mix(self.key[doc] + W.mix(local.astype(np.uint64) | np.uint64(r << 48)))

    def run(self, k: int) -> None:
        docs = np.arange(self.docs)
        everything = np.repeat(docs, np.diff(self.uoff))
        edges, off = self.l.descend(self.l.root[self.unit], self._states(everything, self.local, 0))
        ends = off[self.uoff]
        top = -np.log(-np.log(_uniform(self.key, 1, 0)[:, 0]))
        self._add(docs, [edges[a:z] for a, z in zip(ends[:-1], ends[1:])], np.zeros(self.docs, np.int64), top, 0)
        for r in range(1, k):
            self._round(r)

    def _add(self, docs, paths, step, top, r: int) -> None:
        """New samples, which leave their parents' paths at ``step``: their sets."""
        lp = np.zeros((len(docs), _STEPS + 1))
        before, total = np.zeros(len(docs)), np.zeros(len(docs))
        many = np.zeros(len(docs), np.int64)
        for i, (p, s) in enumerate(zip(paths, step)):
            x = self.l.lp[p]
            before[i], total[i], many[i] = x[:s].sum(), x.sum(), len(p)
            x = x[s : s + _STEPS]
            lp[i, : len(x)] = x
        lead = before[:, None] + np.concatenate([np.zeros((len(docs), 1)), np.cumsum(lp[:, :-1], 1)], 1)
        tail = lead[:, -1]
        # Other edges at a step, and segmentations that differ after the last of these steps.
        mass = np.concatenate([lead[:, :-1] + _log1mexp(lp[:, :-1]), (tail + _log1mexp(np.where(many > step + _STEPS, total - tail, 0.0)))[:, None]], 1)
        mass[:, :-1][lp[:, :-1] > -1e-13] = -np.inf
        value = _truncated(mass, top[:, None], _uniform(self.key[docs], _STEPS + 1, 4 * r + 1))
        for i, d in enumerate(docs):
            self.paths[d].append(paths[i])
            self.values[d].append((float(total[i]), float(top[i])))
            s = int(step[i])
            for j in np.flatnonzero(value[i] > -np.inf):
                self.open[d].append((float(value[i, j]), r, s + int(j), None if j < _STEPS else -1, ()))

    def _split(self, docs: list[int], items: list[tuple], salt: int) -> None:
        """Tail sets become their next steps and a shorter tail, one of which has the set's value."""
        rows, columns = np.arange(len(docs)), np.arange(_STEPS + 1)
        lp, many = np.zeros((len(docs), _STEPS)), np.zeros(len(docs), np.int64)
        before, tail = np.zeros(len(docs)), np.zeros(len(docs))
        for i, (d, (_, r, s, _, _)) in enumerate(zip(docs, items)):
            x = self.l.lp[self.paths[d][r]]
            before[i], tail[i] = x[:s].sum(), x[s + _STEPS :].sum()
            x = x[s : s + _STEPS]
            lp[i, : len(x)], many[i] = x, len(x)
        lead = np.concatenate([np.zeros((len(docs), 1)), np.cumsum(lp, 1)], 1)
        mass = np.full((len(docs), _STEPS + 1), -np.inf)
        mass[:, :-1] = np.where(lp > -1e-13, -np.inf, lead[:, :-1] + _log1mexp(lp))
        mass[rows, many] = lead[rows, many] + _log1mexp(tail)  # nothing where the path ends
        u = _uniform(self.key[docs], _STEPS + 2, salt)
        w = np.cumsum(np.exp(mass - mass.max(1, keepdims=True)), 1)
        lucky = (w < (u[rows, many + 1] * w[:, -1])[:, None]).sum(1)
        value = np.array([x[0] for x in items])
        got = _truncated(mass + before[:, None], value[:, None], u[:, :-1])
        got[rows, lucky] = value
        got[columns > many[:, None]] = -np.inf
        for i, (d, (_, r, s, _, _)) in enumerate(zip(docs, items)):
            n = int(many[i])
            self.open[d] += [(float(got[i, j]), r, s + int(j), None if j < n else -1, ()) for j in np.flatnonzero(got[i] > -np.inf)]

    def _best(self, r: int) -> tuple[list[int], list[tuple]]:
        """Takes the set with the largest value from each document that has one, after its tails are split."""
        best, live, salt = {}, range(self.docs), 4 * r + 2
        while live:
            tails = []
            for d in live:
                if self.open[d]:
                    item = max(self.open[d])
                    self.open[d].remove(item)
                    if item[3] is None:
                        best[d] = item
                    else:
                        tails.append((d, item))
            salt += 1 << 12
            live = [d for d, _ in tails]
            if tails:
                self._split(live, [x for _, x in tails], salt)
        docs = sorted(best)
        return docs, [best[d] for d in docs]

    def _round(self, r: int) -> None:
        docs, items = self._best(r)
        if not docs:
            return
        rows, steps, tops = np.arange(len(docs)), [x[2] for x in items], np.array([x[0] for x in items])
        left = np.array([self.paths[d][x[1]][x[2]] for d, x in zip(docs, items)])
        outs = [x[4] or (int(e),) for x, e in zip(items, left)]
        node = self.l.node(left)
        first, many = self.l.first[node].astype(np.int64), np.diff(self.l.first)[node]
        columns = np.arange(int(many.max()))
        there = columns < many[:, None]
        p = np.where(there, np.exp(self.l.lp[np.where(there, first[:, None] + columns, first[:, None])]), 0.0)
        p[np.repeat(rows, [len(x) for x in outs]), np.array([e for x in outs for e in x]) - np.repeat(first, [len(x) for x in outs])] = 0.0
        u = _uniform(self.key[docs], 2, 4 * r + 3)
        c = np.cumsum(p, 1)
        last = len(columns) - 1 - np.argmax(p[:, ::-1] > 0, 1)
        pick = np.minimum((c <= (u[:, 0] * c[:, -1])[:, None]).sum(1), last)
        edge, rest = first + pick, c[:, -1] - p[rows, pick]
        heads = []
        for i, d in enumerate(docs):
            value, at, s, _, _ = items[i]
            path, out = self.paths[d][at], (*outs[i], int(edge[i]))
            if len(out) < many[i] and rest[i] > 0:
                mass = self.l.lp[path[:s]].sum() + np.log(rest[i])
                self.open[d].append((float(_truncated(np.array(mass), np.array(value), u[i, 1])), at, s, None, out))
            heads.append(np.append(path[:s], edge[i]).astype(np.int32))
        docs = np.array(docs)
        # The rest of the unit in which the path turned off, and all units after it.
        turned = np.array([int(np.count_nonzero(~self.l.inner[self.l.dst[h[:-1]]])) for h in heads])
        first = self.uoff[docs] + turned
        many = self.uoff[docs + 1] - first
        occ = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        node = self.l.root[self.unit[occ]].copy()
        node[np.cumsum(many) - many] = [self.l.dst[h[-1]] for h in heads]
        edges, off = self.l.descend(node, self._states(np.repeat(docs, many), self.local[occ], r))
        ends = off[np.concatenate([[0], np.cumsum(many)])]
        self._add(docs, [np.concatenate([h, edges[a:z]]) for h, a, z in zip(heads, ends[:-1], ends[1:])], np.array(steps) + 1, tops, r)


def _prepared(text: pa.Array) -> pa.Array:
    text = pc.replace_substring(text.cast(pa.large_string()), " ", "▁")
    return pc.binary_join_element_wise(pa.scalar("▁", pa.large_string()), text, pa.scalar("", pa.large_string()))


def _ids(l: Lattice, raw: np.ndarray, edges: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of paths that lie in a row, bytes where an edge has no piece; ids for each path."""
    ids = l.ids[edges]
    lost = ids < 0
    if not lost.any():
        return ids, many
    at = np.flatnonzero(lost)
    char = l.char[l.node(edges[at])]
    begin, wide = l.lead[char], l.lead[char + 1] - l.lead[char]
    width = np.ones(len(edges), np.int64)
    width[at] = wide
    ends = np.cumsum(width)
    out = np.repeat(ids, width)
    inner = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
    out[np.repeat(ends[at] - wide, wide) + inner] = raw[np.repeat(begin, wide) + inner].astype(np.int32) + _BYTE0
    return out, np.add.reduceat(width, np.cumsum(many) - many)


def sample_chunk(text: pa.Array, key: np.ndarray, pieces: Pieces, k: int, alpha: float):
    """(document, sample, ids, ids per sample, log_prob, value, log_inclusion) of a chunk of texts without nulls."""
    raw, off = W.utf8(_prepared(text))
    first = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81))
    end = np.append(first[1:], len(raw))
    _, lead, unit = np.unique(U.hashes(raw, first, end), return_index=True, return_inverse=True)
    lattice = Lattice(raw, first[lead], end[lead], pieces, alpha)
    search = Search(lattice, unit, np.searchsorted(first, off), key)
    search.run(k)
    doc = np.repeat(np.arange(len(key)), [len(p) for p in search.paths])
    paths = [p for x in search.paths for p in x]
    many = np.array([len(p) for p in paths], np.int64)
    lp, value = (np.array(x) for x in zip(*(v for x in search.values for v in x)))
    least = np.array([max((o[0] for o in x), default=-np.inf) for x in search.open])[doc]
    with np.errstate(divide="ignore", over="ignore"):
        gap = lp - least
        inclusion = np.where(gap < -30, gap, _log1mexp(-np.exp(np.minimum(gap, 700.0))))
    sample = np.arange(len(doc)) - np.searchsorted(doc, doc)
    ids, many = _ids(lattice, raw, np.concatenate(paths), many)
    return doc, sample, ids, many, lp, value, inclusion


SCHEMA = "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


@lru_cache(1)
def _pieces(path: str) -> Pieces:
    """Made once per worker."""
    return Pieces(path)


def _run(path: str, k: int, alpha: float):
    def run(batches):
        pieces = _pieces(path)
        for chunk in W.chunks(batches, most_bytes=CHUNK):
            chunk = chunk.filter(pc.is_valid(chunk.column("text")))
            if chunk.num_rows:
                key = chunk.column("key").to_numpy().view(np.uint64)
                doc, sample, ids, many, *rest = sample_chunk(chunk.column("text"), key, pieces, k, alpha)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), pa.array(ids))
                yield pa.record_batch([chunk.column("doc_id").take(pa.array(doc)), pa.array(sample.astype(np.int32)), lists, *map(pa.array, rest)], ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion"])

    return run


def gumbel_segmentations(df: DataFrame, k: int = SAMPLES, alpha: float = ALPHA, seed: int = SEED, vocabulary: str = VOCABULARY, folder: str = U.TOKENIZERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sample, ids, log_prob, perturbed, log_inclusion): k distinct segmentations of every whole text."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_run(U.vocabulary(vocabulary, folder), k, alpha), f"doc_id {kind}, {SCHEMA}")


def _decode(path: str, names: list[str], ids_col: str):
    def run(batches):
        sp = U.piece_encoder(path)
        table = np.array([bytes([i - _BYTE0]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())], object)
        for b in batches:
            out = [None if x is None else b"".join(table[x].tolist()).replace("▁".encode(), b" ")[1:].decode("utf-8", "replace") for x in b.column(ids_col).to_pylist()]
            yield pa.record_batch([*(b.column(n) for n in names), pa.array(out, pa.string())], [*names, "text"])

    return run


def decode(df: DataFrame, ids_col: str = "ids", vocabulary: str = VOCABULARY, folder: str = U.TOKENIZERS) -> DataFrame:
    """df with the text that its ids stand for as ``text`` (which replaces a column of that name); null ids give null."""
    df = df.drop("text")
    return df.mapInArrow(_decode(U.vocabulary(vocabulary, folder), df.columns, ids_col), df.selectExpr("*", "'' AS text").schema)
