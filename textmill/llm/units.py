"""Pieces of text that a tokenizer treats apart, found for whole Arrow chunks at once.

A *unit* is a whitespace-delimited run with the one space before it, or a run
of whitespace: a union of whole pre-tokens of the byte-level vocabularies'
pattern, so that a text's tokens are the tokens of its units in order.  The
piece vocabulary's units are what stands between single spaces.  A document for
which that would not be exact (whitespace beyond ASCII, or runs of spaces for
the piece vocabulary) is one unit as a whole.
"""

from __future__ import annotations

import base64
import importlib.util
import os

import numpy as np
import pyarrow as pa

from . import words as W

#: The folder of the public vocabularies; every operator takes another as a parameter.
TOKENIZERS = "/opt/tokenizers"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _doc_of(at: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, at, "right") - 1


def _far_space(raw: np.ndarray) -> np.ndarray:
    """Positions of white space beyond ASCII."""
    lead = np.flatnonzero((raw == 0xC2) | (raw == 0xE1) | (raw == 0xE2) | (raw == 0xE3))
    a, b, c = raw[lead], raw[np.minimum(lead + 1, len(raw) - 1)], raw[np.minimum(lead + 2, len(raw) - 1)]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    e2 = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return lead[two | e2 | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))]


def _whole(start: np.ndarray, off: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """start without the inner starts of some documents."""
    inside = np.zeros(len(off), bool)
    inside[docs] = True
    return start[~inside[_doc_of(start, off)] | np.isin(start, off)]


def byte_units(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(raw bytes, document offsets, starts, ends) of the units for a byte-level vocabulary."""
    raw, off = W.utf8(col)
    n = len(raw)
    if not n:
        return raw, off, np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    ws = _SPACE[raw]
    prev = np.empty(n, bool)
    prev[0], prev[1:] = False, ws[:-1]
    next_word = np.zeros(n, bool)
    next_word[:-1] = ~ws[1:] & ~edge[1:-1]
    begin = edge[:-1] | (ws & ~prev) | (ws & next_word)
    begin[1:] |= ~ws[1:] & prev[1:] & (raw[:-1] != 32)
    start = np.flatnonzero(begin)
    odd = _far_space(raw)
    if len(odd):
        start = _whole(start, off, _doc_of(odd, off))
    return raw, off, start, np.append(start[1:], n)


def piece_units(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for the piece vocabulary; the space between two units belongs to neither."""
    raw, off = W.utf8(col)
    n = len(raw)
    if not n:
        return raw, off, np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    space = raw == 32
    odd = np.flatnonzero(space & (edge[:-1] | edge[1:] | np.append(space[1:], False)))
    begin = edge[:-1].copy()
    begin[1:] |= space[:-1]
    start = np.flatnonzero(begin)
    odd = np.concatenate([odd, _far_space(raw)])
    if len(odd):
        start = _whole(start, off, _doc_of(odd, off))
    end = np.append(start[1:], n)
    inner = ~edge[end]
    return raw, off, start, end - inner


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = W.power_sums(raw, 1)
    return W.mix(W.unpowered(sums[end] - sums[start], start) + (end - start).astype(np.uint64))


def strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    data = raw.tobytes()
    return [data[a:z].decode("utf-8", "replace") for a, z in zip(start.tolist(), end.tolist())]


def byte_encoder(path: str):
    """encode_ordinary of a byte-level vocabulary of ranks; ``path`` is a .tiktoken file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def piece_encoder(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def vocabulary(name: str, folder: str = TOKENIZERS) -> str:
    """Path of a vocabulary file; a cluster without the folder may have the package that holds it."""
    path = os.path.join(folder, name)
    if not os.path.exists(path) and (spec := importlib.util.find_spec("public_tokenizers")):
        path = os.path.join(os.path.dirname(spec.origin), name)
    return path


class Memo:
    """What a worker knows of units: sorted hashes with a row of numbers each.

    It is a cache of a pure function, and starts anew once it holds ``most``.
    """

    def __init__(self, width: int, most: int = 1_500_000):
        self.width, self.most = width, most
        self.h, self.v = np.zeros(0, np.uint64), np.zeros((0, width), np.int32)

    def get(self, h: np.ndarray, first: np.ndarray, make) -> np.ndarray:
        """Rows for the distinct hashes h; ``make`` gives those of the missing ones, by their place in ``first``."""
        at = np.minimum(np.searchsorted(self.h, h), max(len(self.h) - 1, 0))
        have = self.h[at] == h if len(self.h) else np.zeros(len(h), bool)
        out = np.zeros((len(h), self.width), np.int32)
        out[have] = self.v[at[have]]
        if not have.all():
            new = np.asarray(make(first[~have]), np.int32).reshape(-1, self.width)
            out[~have] = new
            if len(self.h) + len(new) > self.most:
                self.h, self.v = np.zeros(0, np.uint64), np.zeros((0, self.width), np.int32)
            both = np.concatenate([self.h, h[~have]])
            order = np.argsort(both, kind="stable")
            self.h, self.v = both[order], np.concatenate([self.v, new])[order]
        return out
