"""Vectorised word hashing over whole Arrow string batches.

A *word* is a maximal run of ASCII letters, digits, underscores and non-ASCII
characters of the lower-cased text; everything else separates words.  All words
of a chunk of documents are hashed at once with a polynomial prefix sum modulo
2**64, so the cost is a handful of numpy passes over the bytes and no Python
object is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_R = 0x9E3779B97F4A7C15 | 1
_M = (1 << 64) - 1
_R_INV = pow(_R, -1, 1 << 64)

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = True
_IS_WORD[128:] = True

#: Places (a power of two) whose powers are kept; those further on are products.
_BLOCK = 1 << 15
_POW: dict[str, np.ndarray] = {}


def _powers(kind: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, grown by doubling and kept per worker."""
    have = _POW.get(kind)
    if have is None or len(have) <= n:
        out = np.ones(max(1 << 16, 1 << int(n + 1).bit_length()), np.uint64)
        done = 1
        while done < len(out):
            m = min(done, len(out) - done)
            out[done : done + m] = out[:m] * np.uint64(pow(base, done, 1 << 64))
            done += m
        _POW[kind] = have = out
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of uint64 that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def power_sums(x: np.ndarray, plus: int = 0) -> np.ndarray:
    """The n + 1 prefix sums of (x + plus) * _R**place modulo 2**64.

    Powers, terms and sums are made a block at a time: the result is all that is as long as x.
    """
    sums, pw = np.zeros(len(x) + 1, np.uint64), _powers("r", _R, _BLOCK)
    for i in range(0, len(x), _BLOCK):
        part = x[i : i + _BLOCK].astype(np.uint64)
        part += np.uint64(plus)
        part *= pw[: len(part)]
        np.cumsum(part, out=part)
        part *= np.uint64(pow(_R, i, 1 << 64))
        np.add(part, sums[i], out=sums[i + 1 : i + 1 + len(part)])
    return sums


def unpowered(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """x / _R**place modulo 2**64, in x itself."""
    x *= _powers("inv", _R_INV, _BLOCK)[place & (_BLOCK - 1)]
    if len(place) and (last := int(place.max())) >= _BLOCK:
        x *= _powers("inv_block", pow(_R_INV, _BLOCK, 1 << 64), last // _BLOCK)[place // _BLOCK]
    return x


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls as empty) and its n + 1 offsets."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(col: pa.Array, lower: bool = True):
    """(hash, start byte, end byte, n + 1 word offsets) of every word of a chunk.

    Byte positions refer to the concatenated bytes of the chunk as *given*; with
    ``lower`` the positions are those of the lower-cased text, so callers that
    cut the original text must pass ``lower=False``.
    """
    if lower:
        col = pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), ""))
    raw, off = utf8(col)
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = _IS_WORD[raw]
    change = inside[1:] != inside[:-1]
    # A word never runs over a document's end.
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = cut[inside[cut] & inside[cut + 1]]
    starts = np.flatnonzero(change & inside[1:])
    ends = np.flatnonzero(change & inside[:-1])
    if len(both):
        both = np.unique(both)
        starts = np.sort(np.concatenate([starts, both]))
        ends = np.sort(np.concatenate([ends, both]))
    sums = power_sums(raw, 1)
    h = unpowered(sums[ends] - sums[starts], starts)
    return mix(h), starts, ends, np.searchsorted(starts, off)


def word_ngrams(h: np.ndarray, woff: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams and their document offsets.

    A document of fewer than n words (but one at least) has one n-gram, made of
    all its words; a document without words has none.
    """
    count = np.diff(woff)
    many = np.maximum(count - n + 1, np.minimum(count, 1))
    off = np.concatenate([[0], np.cumsum(many)])
    at = np.arange(off[-1]) - np.repeat(off[:-1], many) + np.repeat(woff[:-1], many)
    end = np.repeat(woff[1:], many)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        here = at + k
        word = h[np.minimum(here, max(len(h) - 1, 0))] if len(h) else out
        out = mix(out * np.uint64(_R) + np.where(here < end, word, np.uint64(k + 1)))
    return out, off


def chunks(batches, column: str = "text", most_bytes: int = 3_000_000, most_rows: int = 16_000):
    """Record batches cut or kept so that each holds at most so many text bytes.

    One longer document is a chunk of its own: no text is ever cut.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(size), 0
        while at < len(size):
            base = total[at - 1] if at else 0
            to = int(np.searchsorted(total, base + most_bytes, "right"))
            to = min(max(to, at + 1), at + most_rows, len(size))
            yield batch.slice(at, to - at)
            at = to
