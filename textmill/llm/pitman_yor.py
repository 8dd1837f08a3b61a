"""Perplexity under a hierarchical Pitman-Yor model of pieces or characters, trained on the corpus itself.

Symbols are the pieces of a public vocabulary, or characters where none is
named.  The context of a symbol is the order - 1 symbols before it.  Each context
is a restaurant whose customers are the symbols seen after it, whose dishes come
from the restaurant of the context without its oldest symbol, and so on up to the
empty context, which all share, over a uniform base.  N-grams of pieces are no
closed set: the restaurants grow with the corpus.

1. Counts: every chunk of documents sends its distinct n-grams with their counts
   to hash buckets, which add them up.  All of every text is counted.
2. Seating: contexts that end alike share all their parents but the empty one,
   so a shard is what ends with one character, or with the pieces of one hash
   bucket, and holds its restaurants of every length.  A Gibbs sweep draws the
   number of tables of each dish in each restaurant from its conditional, given
   the other dishes' tables and the parent's predictive probability, in which
   generalised Stirling numbers count the seatings: a table up to KNOWN customers, a convergent series or a
   saddle point beyond.  Up to TABLE customers the conditional is drawn, beyond
   STEPS Metropolis steps have that same conditional as their law.  Dishes of a
   restaurant take turns in two halves.  Each table sends one customer to the
   parent.
3. The empty context is part of the same chain: after each sweep the shards'
   tables, a row per character of the alphabet or piece of the vocabulary, are
   its customers, its own tables are drawn, and its probabilities are the base of the next sweep.
   So are the strengths of each length, drawn from their conditional by auxiliary
   variables; discounts follow the counts of dishes of one and two customers.
   A sweep reads the shards' states from the table of the sweep before and writes
   the next, so a lost executor costs a part of one sweep.
4. Predictive probabilities are averaged over the SWEEPS sweeps after burn-in.
5. Scoring: chunks send how often each of their documents has each n-gram, the
   bucket joins the probabilities, and a sum per document comes back.

Defined results: documents are padded, and their end is predicted too, so a null
or empty text has one event; repeated rows are counted and scored each; a null
id stays null; a text however long is scored as one; equal texts have equal
scores.  Ids must be integers or castable to them.  Other columns are ignored.
"""

from __future__ import annotations

import pickle
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import units as U
from . import words as W
from .exchange import binary, blobs, bucket, buckets, chunk_ids, cut, pack6, release, unpack6

ORDER, DISCOUNT, STRENGTH, BURN_IN, SWEEPS, SEED, TABLE, KNOWN, STEPS = 5, 0.75, 1.0, 4, 10, 29, 48, 1024, 2
#: The registered query's pieces and n-grams of them; shards of pieces for each bucket.
VOCABULARY, PIECE_ORDER, SHARDS = "piece_bpe_32k.model", 3, 1
_PAD, _END = 0x2, 0x3
#: Dishes whose tables are drawn at once, which bounds what a worker holds.
_AT_ONCE = 1 << 13
#: Units encoded at once: as Python lists their pieces take some hundred bytes a unit.
_ENCODED = 1 << 14


def symbols(text: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each with pads before and an end after; offsets of the first event of each, and of the end."""
    texts = ["" if t is None else t for t in text.to_pylist()]
    lead, tail = chr(_PAD) * (order - 1), chr(_END)
    size = np.array([len(t) for t in texts], np.int64)
    cps = np.frombuffer("".join(lead + t + tail for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    off = np.concatenate([[0], np.cumsum(size + order)])
    return cps, off


def _places(most: int):
    """The kind of number for places below that: a worker holds several arrays of them as long as a chunk."""
    return np.int32 if most < 1 << 31 else np.int64


def grams(cps: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, document) of every n-gram of every document."""
    many, kind = np.diff(off) - order + 1, _places(len(cps))
    start = np.arange(many.sum(), dtype=kind)
    start += np.repeat((off[:-1] - np.cumsum(many) + many).astype(kind), many)
    h = np.zeros(len(start), np.uint64)
    for k in range(order):
        h *= np.uint64(W._R)
        h += cps[start + k]
        h += np.uint64(1)
    return W.mix(h), start, np.repeat(np.arange(len(many), dtype=kind), many)


class Known:
    """Ids of the units that a worker has met: a cache of a pure function, which starts anew once it holds ``most``."""

    def __init__(self, sp, most: int = 600_000):
        self.sp, self.most = sp, most
        self._forget()

    def _forget(self) -> None:
        self.h, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def get(self, u: np.ndarray, strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size) for distinct rising hashes; ``strings`` gives the units of some places of them."""
        at = np.minimum(np.searchsorted(self.h, u), max(len(self.h) - 1, 0))
        have = self.h[at] == u if len(self.h) else np.zeros(len(u), bool)
        if not have.all():
            if len(self.h) + int((~have).sum()) > self.most:
                self._forget()
                have[:] = False
            new = np.flatnonzero(~have)
            sizes, flats = [], []
            for i in range(0, len(new), _ENCODED):
                got = self.sp.encode(strings(new[i : i + _ENCODED]), num_threads=1)
                sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
                flats.append(np.fromiter(chain.from_iterable(got), np.uint16, int(sizes[-1].sum())))
                del got
            size = np.concatenate(sizes)
            begin = np.cumsum(size) - size + len(self.flat)
            self.flat = np.concatenate([self.flat, *flats])
            to = np.searchsorted(self.h, u[new])
            self.h, self.begin, self.size = np.insert(self.h, to, u[new]), np.insert(self.begin, to, begin), np.insert(self.size, to, size)
            at = np.searchsorted(self.h, u)
        return self.flat, self.begin[at], self.size[at]


def _hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """Hashes of units, made for so many bytes at a time (or one unit of more): their powers and sums take 40 bytes a byte."""
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        z = max(int(np.searchsorted(start, start[i] + most)), i + 1)
        out[i:z] = U.hashes(raw[start[i] : end[z - 1]], start[i:z] - start[i], end[i:z] - start[i])
        i = z
    return out


def pieces(text: pa.Array, order: int, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """The same of pieces; ids are moved by 4, past the pad and the end."""
    raw, doc, start, end = U.piece_units(text)
    u, first, inverse = np.unique(_hashes(raw, start, end), return_index=True, return_inverse=True)
    flat, begin, size = known.get(u, lambda new: U.strings(raw, start[first[new]], end[first[new]]))
    per, begin = size[inverse], begin[inverse]
    ends = np.concatenate([[0], np.cumsum(per)])
    n = np.diff(ends[np.searchsorted(start, doc)])
    del raw, start, end, u, first, inverse, size
    off = np.concatenate([[0], np.cumsum(n + order)])
    out, kind = np.full(off[-1], _PAD, np.uint32), _places(max(off[-1], len(flat)))
    to = np.arange(ends[-1], dtype=kind)
    at = np.repeat((begin - ends[:-1]).astype(kind), per)
    at += to
    to += np.repeat((off[:-1] + order - 1 - (np.cumsum(n) - n)).astype(kind), n)
    out[to] = flat[at] + np.uint32(4)
    out[off[1:] - 1] = _END
    return out, off


def _reader(order: int, path: str | None):
    if path is None:
        return lambda text: symbols(text, order)
    known = Known(U.piece_encoder(path))
    return lambda text: pieces(text, order, known)


def _kind(path: str | None):
    return np.uint16 if path else np.uint32  # a vocabulary has fewer than 65,532 pieces


def _chunk_counts(text: pa.Array, read, order: int, many: int, kind) -> pa.RecordBatch:
    """A row for each bucket; what was made of one chunk is gone before the next is read."""
    cps, off = read(text)
    h, start, _ = grams(cps, off, order)
    u, first, count = np.unique(h, return_index=True, return_counts=True)
    del h
    rows = cps[start[first][:, None] + np.arange(order, dtype=start.dtype)].astype(kind)
    del cps, start, first
    to = np.searchsorted(bucket(u, many), np.arange(many + 1))
    used = [k for k in range(many) if to[k] < to[k + 1]]
    return pa.record_batch([pa.array(used, pa.int64()), *(pa.array([binary(x[to[k] : to[k + 1]]) for k in used], pa.binary()) for x in (rows, count.astype(np.uint32)))], ["bucket", "gram", "count"])


def _send_counts(order: int, many: int, path: str | None):
    def run(batches):
        read = _reader(order, path)
        for chunk in W.chunks(batches):
            yield _chunk_counts(chunk.column("text"), read, order, many, _kind(path))

    return run


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        h = h * np.uint64(W._R) + rows[:, k].astype(np.uint64) + np.uint64(1)
    return W.mix(h)


def _merge_counts(order: int, shards: int, path: str | None):
    """Of one bucket: a row for each shard with its n-grams and their counts."""

    def run(t: pa.Table) -> pa.Table:
        rows = np.concatenate(blobs(t["gram"], _kind(path))).reshape(-1, order)
        _, first, inverse = np.unique(_hash_rows(rows), return_index=True, return_inverse=True)
        count = np.bincount(inverse, np.concatenate(blobs(t["count"], np.uint32))).astype(np.int64)
        rows = rows[first]
        last = rows[:, -2].astype(np.uint64)
        shard = bucket(W.mix(last), shards) if path else last.astype(np.int64)
        by = np.argsort(shard, kind="stable")
        rows, count, shard = rows[by], count[by], shard[by]
        at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        ends = np.append(at[1:], len(shard))
        return pa.table({"shard": shard[at], "gram": pa.array([binary(rows[a:z]) for a, z in zip(at, ends)], pa.binary()), "count": pa.array([binary(count[a:z]) for a, z in zip(at, ends)], pa.binary())})

    return run


_STIRLING: dict[float, np.ndarray] = {}  # of the discounts used last
#: Discounts are rounded to such steps, so that tables of Stirling numbers are few.
_STEP = 0.01


def stirling(d: float) -> np.ndarray:
    """log S(c, t) up to KNOWN customers: the seatings of c customers at t tables, weighted as the discount d does."""
    if d not in _STIRLING:
        while len(_STIRLING) >= 3:
            _STIRLING.pop(next(iter(_STIRLING)))
        s, t = np.full((KNOWN + 1, KNOWN + 1), -np.inf), np.arange(KNOWN + 1)
        s[0, 0] = 0.0
        for c in range(KNOWN):
            s[c + 1, 1:] = np.logaddexp(s[c, :-1], s[c, 1:] + np.log(np.maximum(c - t[1:] * d, 1e-300)))
        _STIRLING[d] = s
    return _STIRLING[d]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma from Stirling's series, right to 1e-9 from 8 on."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma of positive numbers."""
    x = np.asarray(x, float)
    return _log_gamma(x + 8) - np.log(x * (x + 1) * (x + 2) * (x + 3)) - np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def _tilt(w: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of x with log odds w: log x, log(1 - x), log(1 - (1 - x)^d), and the log of the mean size of a table when sizes are weighted by x^size."""
    lu = -np.logaddexp(0, w)
    lx, lf = w + lu, np.log(-np.expm1(d * lu))
    return lx, lu, lf, np.log(d) + lx + (d - 1) * lu - lf


_GRID: dict[float, tuple[np.ndarray, np.ndarray]] = {}  # of the discounts used last


def _grid(d: float) -> tuple[np.ndarray, np.ndarray]:
    if d not in _GRID:
        while len(_GRID) >= 6:
            _GRID.pop(next(iter(_GRID)))
        w = np.concatenate([np.linspace(-45, -6, 2000), np.linspace(-6, 60, 20000), np.linspace(60, 700, 4000)])
        _GRID[d] = _tilt(w, d)[3], w
    return _GRID[d]


def _saddle(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    goal, e = np.log(c / t), 1 - d
    w = np.interp(goal, *_grid(d))
    for step in range(3):  # Newton's steps from the grid's value
        lx, lu, lf, mean = _tilt(w, d)
        m, r = np.exp(mean), np.exp(w)
        m2 = m * (1 + e * r)
        k2 = m2 - m * m
        if step < 2:
            w = w - np.clip((mean - goal) * m / np.maximum(k2 * np.exp(lu), 1e-300), -0.05, 0.05)
    m3, m4 = m * (1 + 3 * e * r + e * (2 - d) * r * r), m * (1 + 7 * e * r + 6 * e * (2 - d) * r * r + e * (2 - d) * (3 - d) * r**3)
    k3, k4 = m3 - 3 * m2 * m + 2 * m**3, m4 - 4 * m3 * m - 3 * m2 * m2 + 12 * m2 * m * m - 6 * m**4
    return t * lf - c * lx - 0.5 * np.log(2 * np.pi * t * k2) + (k4 / k2**2 / 8 - 5 * k3**2 / k2**3 / 24) / t


def _series(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    j = np.arange(1.0, 121 if d > 0.75 else 61)
    left, rest = t[:, None] - j + 1, c[:, None] - j * d
    # Where less than one is left the term is far below the others, so the series' first terms do.
    x = np.maximum(rest, 1)
    size = np.cumsum(np.log(np.maximum(left, 1)), axis=1) + (x - 0.5) * np.log(x) - x + 1 / (12 * x) + (log_gamma(1 + j * d) - log_gamma(j + 1))
    size[(left <= 0) | (rest <= 0)] = -np.inf
    top = size.max(1)
    sign = np.where(j % 2 == 1, 1, -1) * np.sin(np.pi * j * d) / np.pi
    total = np.exp(size - top[:, None]) @ sign
    return top + np.log(np.maximum(total, 1e-300)) + 0.5 * np.log(2 * np.pi) - log_gamma(c + 1)


def log_stirling(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log S(c, t) at any size."""
    c, t = np.asarray(c, float), np.asarray(t, float)
    known = c <= KNOWN
    out = np.empty(len(c))
    out[known] = stirling(d)[c[known].astype(np.int64), t[known].astype(np.int64)]
    out[~known] = far_stirling(c[~known], t[~known], d)
    return out


def far_stirling(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """The same from c! / (t! d^t) [x^c] (1 - (1 - x)^d)^t, for tens of customers or more.

    The binomial series is used where its terms hardly cancel, else a saddle
    point with its second term.
    """
    c, t = np.asarray(c, float), np.asarray(t, float)
    out = t * np.log(d)  # the value at t = c
    depth = np.exp(np.log(1 - d) + (d * np.log(d) + np.log(t) - d * np.log(c)) / (1 - d))
    few = (depth < (4 if d <= 0.6 else 2)) & (t < c)
    many = ~few & (t < c)
    for i in np.split(np.flatnonzero(few), range(8192, int(few.sum()), 8192)):
        out[i] = _series(c[i], t[i], d)
    out[many] = _saddle(c[many], t[many], d)
    return out + log_gamma(c + 1) - log_gamma(t + 1) - t * np.log(d)


def _centre(c: np.ndarray, z: np.ndarray, parent: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """About where the conditional of t has its mode, and its width."""

    def slope(w):
        _, _, lf, mean = _tilt(w, d)
        t = c * np.exp(-mean)
        return t, lf + np.log1p(z / t) + np.log(parent)

    low, high = np.full(len(c), -45.0), np.full(len(c), 300.0)
    for _ in range(16):  # proposals need no more
        w = (low + high) / 2
        up = slope(w)[1] < 0  # too many tables: more weight on large ones
        low, high = np.where(up, w, low), np.where(up, high, w)
    (t0, g0), (t1, g1) = slope(w - 0.05), slope(w + 0.05)
    width = np.sqrt(np.maximum((t0 - t1) / np.maximum(g1 - g0, 1e-9), 0))
    return np.clip(np.sqrt(t0 * t1), 1, c), np.clip(np.nan_to_num(width, nan=1, posinf=1), 1, np.sqrt(c))


def _metropolis(t: np.ndarray, c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """t after STEPS steps whose proposals are logistic around the centre."""
    c = c.astype(float)
    z = strength / d + others
    centre, width = _centre(c, z, parent, d)
    scale = 0.75 * width

    def worth(t):
        a, one = (np.abs(t - centre) - 0.5) / scale, 1 / scale
        proposed = -a + np.log(-np.expm1(-one)) - np.logaddexp(0, -a) - np.logaddexp(0, -a - one)
        # strength + d others rises by d for each new table, and each new table's dish comes from the parent.
        return log_stirling(c, t, d) + t * np.log(d) + log_gamma(t + z) - log_gamma(z) + t * np.log(parent) - proposed

    t = np.clip(t.astype(float), 1, c)
    now = worth(t)
    for _ in range(STEPS):
        u = np.clip(rng.random(len(c)), 1e-12, 1 - 1e-12)
        to = np.rint(centre + scale * np.log(u / (1 - u)))
        ok = (to >= 1) & (to <= c)
        then = worth(np.where(ok, to, t))
        ok &= np.log(np.maximum(rng.random(len(c)), 1e-300)) < then - now
        t, now = np.where(ok, to, t), np.where(ok, then, now)
    return t.astype(np.int64)


def draw_tables(c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, strength: float, rng: np.random.Generator, now: np.ndarray | None = None) -> np.ndarray:
    """Tables of dishes with c customers, given the tables of the restaurant's other dishes and the parent's probability; ``now`` are the tables they have."""
    t = np.minimum(c, 1)
    i = np.flatnonzero((c > 1) & (c <= TABLE))
    i = i[np.argsort(c[i], kind="stable")]
    for at in range(0, len(i), _AT_ONCE):
        j = i[at : at + _AT_ONCE]
        n = c[j]
        k = np.arange(1, int(n[-1]) + 1)
        # [strength + d others] rises by d for each new table, and each new table's dish comes from the parent.
        rise = np.cumsum(np.log(strength + d * (others[j, None] + k[None] - 1)), axis=1)
        lw = stirling(d)[:, 1 : len(k) + 1][n] + rise + k * np.log(parent[j])[:, None]
        w = np.cumsum(np.exp(lw - lw.max(1, keepdims=True)), axis=1)
        t[j] = 1 + (w < rng.random(len(j))[:, None] * w[:, -1:]).sum(1)
    i = np.flatnonzero(c > TABLE)
    for at in range(0, len(i), _AT_ONCE):
        j = i[at : at + _AT_ONCE]
        t[j] = _metropolis((t if now is None else now)[j], c[j], others[j], parent[j], d, strength, rng)
    return t


class Shard:
    """Restaurants of all contexts that end with one character, of lengths order - 1 to 1."""

    def __init__(self, rows: np.ndarray, count: np.ndarray, base: np.ndarray, d, strength):
        n = rows.shape[1]
        self.d, self.strength = (np.broadcast_to(np.asarray(x, float), n - 1) for x in (d, strength))  # longest context first
        self.base = base  # probability of each leaf's symbol under the empty context
        self.levels = []  # (restaurant of each dish, parent dish of each dish)
        leaf = np.arange(len(rows))
        keep = leaf
        for length in range(n - 1, 0, -1):
            own = rows[keep][:, n - 1 - length :]
            _, rest = np.unique(_hash_rows(own[:, :-1]), return_inverse=True)
            if length > 1:
                _, first, up = np.unique(_hash_rows(own[:, 1:]), return_index=True, return_inverse=True)
                self.levels.append((rest, up))
                keep = keep[first]
            else:
                self.levels.append((rest, None))
        self.top = keep  # leaves that stand for the dishes of the shortest context
        self.c = [count.astype(np.int64)]
        for _, up in self.levels[:-1]:
            self.c.append(np.bincount(up, np.minimum(self.c[-1], 1)).astype(np.int64))
        self.t = [np.minimum(c, 1) for c in self.c]

    def predictive(self) -> list[np.ndarray]:
        out: list = [None] * len(self.levels)
        for k in range(len(self.levels) - 1, -1, -1):
            rest, up = self.levels[k]
            c, t = np.bincount(rest, self.c[k]), np.bincount(rest, self.t[k])
            parent = self.base[self.top] if up is None else out[k + 1][up]
            out[k] = (self.c[k] - self.d[k] * self.t[k] + (self.strength[k] + self.d[k] * t[rest]) * parent) / (self.strength[k] + c[rest])
        return out

    def sweep(self, rng: np.random.Generator) -> None:
        p = self.predictive()
        for k, (rest, up) in enumerate(self.levels):
            parent = self.base[self.top] if up is None else p[k + 1][up]
            half = rng.random(len(rest)) < 0.5
            for turn in (half, ~half):
                total = np.bincount(rest, self.t[k])[rest]
                i = np.flatnonzero(turn)
                self.t[k][i] = draw_tables(self.c[k][i], total[i] - self.t[k][i], parent[i], self.d[k], self.strength[k], rng, self.t[k][i])
            if up is not None:
                self.c[k + 1] = np.bincount(up, self.t[k]).astype(np.int64)


def strength_sums(c: np.ndarray, t: np.ndarray, d: float, strength: float, rng: np.random.Generator) -> tuple[float, int]:
    """Of restaurants with c customers at t tables: the auxiliary sums from which a strength with a gamma prior is drawn."""
    some = c > 1
    log_x = float(np.log(np.maximum(rng.beta(strength + 1, c[some] - 1), 1e-300)).sum())
    # Of every table but a restaurant's first, whether it opened for the strength and not for the discount.
    more = np.bincount(t[t > 0])[::-1].cumsum()[::-1][2:]  # more[i - 1]: restaurants with more than i tables
    i = np.arange(1, len(more) + 1)
    return log_x, int(rng.binomial(more, strength / (strength + d * i)).sum())


def draw_strength(log_x: float, opened: int, restaurants: int, rng: np.random.Generator) -> float:
    """Gamma(1, 1) prior; each restaurant's first table opens for the strength."""
    return float(np.clip(rng.gamma(1 + opened, 1 / (1 - log_x)), 0.01, 1e4)) if restaurants else STRENGTH


def counted_discount(ones: int, twos: int) -> float:
    """The discount that counts of counts suggest."""
    return float(np.clip(round(ones / max(ones + 2 * twos, 1) / _STEP) * _STEP, 0.05, 0.9)) if ones else DISCOUNT


def _customers(symbol: np.ndarray, tables: np.ndarray) -> list[list]:
    """The symbols of a shard's shortest contexts and the tables that they send to the empty one."""
    u, inverse = np.unique(symbol, return_inverse=True)
    return [u.tolist(), np.bincount(inverse, tables).astype(np.int64).tolist()]


def _start(order: int, path: str | None):
    """The state of one shard before the first sweep."""

    def run(t: pa.Table) -> pa.Table:
        rows = np.concatenate(blobs(t["gram"], _kind(path))).reshape(-1, order)
        by = np.lexsort(rows.T)
        rows, count = rows[by], np.concatenate(blobs(t["count"], np.int64))[by]
        s = Shard(rows, count, np.zeros(len(rows)), DISCOUNT, STRENGTH)
        state = {"levels": [(r.astype(np.int32), None if u is None else u.astype(np.int32)) for r, u in s.levels], **_small(s), "h": _hash_rows(rows), "symbol": rows[s.top, -1].astype(np.int32), "total": np.zeros(len(rows), np.float32)}
        sym, tables = _customers(state["symbol"], s.t[-1])
        return pa.table({"shard": t["shard"][:1], "state": pa.array([pickle.dumps(state, 5)], pa.binary()), "symbols": pa.array([sym], pa.list_(pa.int64())), "tables": pa.array([tables], pa.list_(pa.int64()))})

    return run


def _small(s: Shard) -> dict:
    """Customers and tables, each level in as few bytes as its largest needs."""
    return {k: [x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in xs] for k, xs in (("c", s.c), ("t", s.t))}


SWEPT = "shard bigint, state binary, symbols array<bigint>, tables array<bigint>, log_x array<double>, opened array<bigint>, restaurants array<bigint>, ones array<bigint>, twos array<bigint>"


def _sweep(base: tuple, rest: float, d: list, strength: list, seed: int, number: int, keep: bool):
    """The state of each shard after one more sweep, and what the empty context and the parameters need of it."""

    def run(batches):
        for batch in batches:
            for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("state").to_pylist()):
                state, rng = pickle.loads(blob), np.random.default_rng([seed, number, shard])
                s = Shard.__new__(Shard)
                s.levels, s.d, s.strength = state["levels"], d, strength
                s.c, s.t = ([x.astype(np.int64) for x in state[k]] for k in "ct")
                at = np.minimum(np.searchsorted(base[0], state["symbol"]), len(base[0]) - 1)
                s.base, s.top = np.where(base[0][at] == state["symbol"], base[1][at], rest), slice(None)
                s.sweep(rng)
                if keep:
                    state["total"] = (state["total"] + s.predictive()[0]).astype(np.float32)
                state |= _small(s)
                sums = []
                for k, (r, _) in enumerate(s.levels):
                    c, t = np.bincount(r, s.c[k]).astype(np.int64), np.bincount(r, s.t[k]).astype(np.int64)
                    sums.append((*strength_sums(c, t, d[k], strength[k], rng), len(c), int((s.c[k] == 1).sum()), int((s.c[k] == 2).sum())))
                out = [[x] for x in ([*map(list, zip(*sums))])]
                sent = _customers(state["symbol"], s.t[-1])
                yield pa.record_batch([pa.array([shard]), pa.array([pickle.dumps(state, 5)], pa.binary()), *(pa.array([x], pa.list_(pa.int64())) for x in sent), *(pa.array(x) for x in out)], [x.split()[0] for x in SWEPT.split(", ")])

    return run


def _model(sweeps: int, many: int):
    """Averaged log probability of every n-gram, a row for each bucket."""

    def run(batches):
        for batch in batches:
            for blob in batch.column("state").to_pylist():
                state = pickle.loads(blob)
                by = np.argsort(state["h"])
                h, lp = state["h"][by], np.log(state["total"][by].astype(float) / sweeps).astype(np.float32)
                to = np.searchsorted(bucket(h, many), np.arange(many + 1))
                used = [k for k in range(many) if to[k] < to[k + 1]]
                yield pa.record_batch([pa.array(used, pa.int64()), *(pa.array([binary(x[to[k] : to[k + 1]]) for k in used], pa.binary()) for x in (h, lp))], ["bucket", "h", "lp"])

    return run


class Root:
    """The restaurant of the empty context, over a uniform base of the alphabet and one character more."""

    def __init__(self, d: float, strength: float):
        self.d, self.strength, self.t = d, strength, {}

    def sweep(self, customers: dict[int, int], rng: np.random.Generator) -> tuple[dict[int, float], float]:
        """Draw its tables and strength; its probability of each symbol, and of one never seen."""
        sym = sorted(customers)
        c = np.array([customers[x] for x in sym], np.int64)
        v = len(sym) + 1
        t = np.clip(np.array([self.t.get(x, 1) for x in sym], np.int64), np.minimum(c, 1), c)
        half = rng.random(len(c)) < 0.5
        for turn in (half, ~half):
            t[turn] = draw_tables(c[turn], t.sum() - t[turn], np.full(turn.sum(), 1 / v), self.d, self.strength, rng, t[turn])
        self.t = dict(zip(sym, t.tolist()))
        log_x, opened = strength_sums(np.array([c.sum()]), np.array([t.sum()]), self.d, self.strength, rng)
        self.strength = draw_strength(log_x, opened, 1, rng)
        more = (self.strength + self.d * t.sum()) / v
        p = (c - self.d * t + more) / (self.strength + c.sum())
        return dict(zip(sym, p.tolist())), float(more / (self.strength + c.sum()))


_COLUMNS = ["bucket", "chunk", "h", "per", "gram", "freq"]


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, rising, and which of them each is."""
    order = np.argsort(h).astype(_places(len(h)))
    u = h[order]
    new = np.append(True, u[1:] != u[:-1])[: len(u)]
    which = np.empty_like(order)
    which[order] = np.cumsum(new, dtype=order.dtype) - 1
    return u[new], which


def _chunk_documents(chunk: pa.RecordBatch, c: int, read, order: int, many: int) -> list[pa.RecordBatch]:
    """A header row, and a row for each bucket; what was made of one chunk is gone before the next is read."""
    docs = chunk.num_rows
    cps, off = read(chunk.column("text"))
    h, start, doc = grams(cps, off, order)
    del start, cps
    u, which = _distinct(h)
    del h
    key = doc.astype(np.int64)
    key <<= 32
    key |= which
    del doc, which
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    freq, key = np.diff(np.append(new, len(key))).astype(_places(len(key))), key[new]
    del new
    doc, gram = (key >> 32).astype(_places(docs)), (key & 0xFFFFFFFF).astype(_places(len(u)))
    del key
    b = bucket(u, many)
    lead = np.searchsorted(b, np.arange(many + 1))
    of = b.astype(np.uint16 if many <= 65536 else np.int64)[gram]
    slot = of.astype(np.int64)
    slot *= docs
    slot += doc
    per = np.bincount(slot, minlength=many * docs).reshape(many, docs)
    del slot, doc, b
    at = np.concatenate([[0], np.cumsum(per.sum(1))])
    gram -= lead.astype(gram.dtype)[of]
    order_ = np.argsort(of, kind="stable")
    del of
    gram, freq = gram[order_], freq[order_]
    del order_
    small = np.uint16 if np.diff(lead).max(initial=0) < 65536 else np.uint32
    ids, events = chunk.column("doc_id"), np.diff(off) - order + 1
    head = pa.record_batch([pa.array([many + c % many], pa.int64()), pa.array([c], pa.int64()), *(pa.array([binary(x)], pa.binary()) for x in (ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), events, np.zeros(0)))], _COLUMNS)
    used = [k for k in range(many) if lead[k] < lead[k + 1]]
    cols: list[list[bytes]] = [[], [], [], []]
    for k in used:
        f = freq[at[k] : at[k + 1]]
        # 255 stands for a frequency that follows at the end.
        packed = np.concatenate([np.minimum(f, 255).astype(np.uint8), f[f >= 255].astype("<u4").view(np.uint8)])
        for col, x in zip(cols, (pack6(u[lead[k] : lead[k + 1]]), binary(per[k].astype(np.uint32)), binary(gram[at[k] : at[k + 1]].astype(small)), binary(packed))):
            col.append(x)
    return [head, pa.record_batch([pa.array(used, pa.int64()), pa.array([c] * len(used), pa.int64()), *(pa.array(x, pa.binary()) for x in cols)], _COLUMNS)]


def _send_documents(order: int, many: int, path: str | None):
    def run(batches):
        ids, read = chunk_ids(), _reader(order, path)
        for chunk in W.chunks(batches):
            yield from _chunk_documents(chunk, next(ids), read, order, many)

    return run


SUMS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _score(many: int):
    def run(t: pa.Table, model: pa.Table) -> pa.Table:
        if not t.num_rows:
            return SUMS.empty_table()
        if t["bucket"][0].as_py() >= many:
            return pa.table([t["bucket"], t["chunk"], t["h"], t["per"], t["gram"]], schema=SUMS)
        h, lp = np.concatenate(blobs(model["h"], np.uint64)) & np.uint64((1 << 48) - 1), np.concatenate(blobs(model["lp"], np.float32)).astype(float)
        order = np.argsort(h)
        h, lp = h[order], lp[order]
        out = []
        for u, per, gram, freq in zip(map(unpack6, blobs(t["h"], np.uint8)), blobs(t["per"], np.uint32), t["gram"].to_pylist(), blobs(t["freq"], np.uint8)):
            n = int(per.sum())
            g = np.frombuffer(gram, np.uint16 if len(gram) == 2 * n else np.uint32)
            f = freq[:n].astype(np.int64)
            f[f == 255] = np.frombuffer(freq[n:].tobytes(), "<u4")
            ends = np.concatenate([[0], np.cumsum(lp[np.searchsorted(h, u)][g] * f)])
            out.append(binary(np.diff(ends[np.concatenate([[0], np.cumsum(per, dtype=np.int64)])]).astype(np.float32)))
        none = pa.array([None] * len(out), pa.binary())
        return pa.table([t["bucket"], t["chunk"], none, none, pa.array(out, pa.binary())], schema=SUMS)

    return run


def _add(t: pa.Table) -> pa.Table:
    t = t.sort_by("bucket")
    rows = list(zip(t["a"].to_pylist(), t["b"].to_pylist(), t["c"].to_pylist()))
    ids, valid, events = next((np.frombuffer(a, np.int64), np.frombuffer(b, bool), np.frombuffer(c, np.int64)) for a, b, c in rows if a is not None)
    lp = sum((np.frombuffer(c, np.float32).astype(np.float64) for a, _, c in rows if a is None), np.zeros(len(ids)))
    return pa.table({"doc_id": pa.array(ids, mask=~valid), "events": events, "log_prob": lp, "perplexity": np.exp(-lp / events)})


def pitman_yor_perplexity(df: DataFrame, order: int = ORDER, discount: float = DISCOUNT, strength: float = STRENGTH, burn_in: int = BURN_IN, sweeps: int = SWEEPS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, folder: str = U.TOKENIZERS) -> DataFrame:
    """(doc_id, events, log_prob, perplexity) of every document, under the model of all documents.

    events counts a document's symbols and its end; log_prob is natural.  Symbols
    are the pieces of ``vocabulary``, a piece model in ``folder``; characters
    without one.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = df.sparkSession
    many = buckets(spark)
    path = U.vocabulary(vocabulary, folder) if vocabulary else None
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.select("text").mapInArrow(_send_counts(order, many, path), "bucket bigint, gram binary, count binary")
    counts = cut(sent.groupBy("bucket").applyInArrow(_merge_counts(order, SHARDS * many, path), "shard bigint, gram binary, count binary"))
    rng, root = np.random.default_rng(seed), Root(discount, strength)
    ds, strengths = [discount] * (order - 1), [strength] * (order - 1)
    state = cut(counts.groupBy("shard").applyInArrow(_start(order, path), "shard bigint, state binary, symbols array<bigint>, tables array<bigint>"))
    release(counts)
    for number in range(burn_in + sweeps):
        # To the driver come a row per character of the alphabet or piece of the vocabulary, and a row of sums.
        customers = {r[0]: r[1] for r in state.select(F.explode(F.arrays_zip("symbols", "tables")).alias("z")).groupBy("z.symbols").agg(F.sum("z.tables")).collect()}
        base, rest = root.sweep(customers, rng) if customers else ({_END: 1.0}, 1.0)
        known = np.array(sorted(base), np.int64)
        base = known, np.array([base[x] for x in known.tolist()])
        before, state = state, cut(state.select("shard", "state").mapInArrow(_sweep(base, rest, ds, strengths, seed, number, number >= burn_in), SWEPT))
        release(before)
        names, levels = ("log_x", "opened", "restaurants", "ones", "twos"), range(order - 1)
        sums = state.agg(*[F.sum(F.col(x)[k]) for k in levels for x in names]).first()
        for k in levels:
            log_x, opened, restaurants, ones, twos = (x or 0 for x in sums[k * len(names) : (k + 1) * len(names)])
            strengths[k], ds[k] = draw_strength(log_x, opened, restaurants, rng), counted_discount(ones, twos)
    model = cut(state.mapInArrow(_model(sweeps, many), "bucket bigint, h binary, lp binary"))
    release(state)
    entries = docs.mapInArrow(_send_documents(order, many, path), "bucket bigint, chunk bigint, h binary, per binary, gram binary, freq binary")
    sums = entries.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(_score(many), "bucket bigint, chunk bigint, a binary, b binary, c binary")
    return sums.groupBy("chunk").applyInArrow(_add, "doc_id bigint, events bigint, log_prob double, perplexity double")
