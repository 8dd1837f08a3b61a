"""Tokeniser fertility as a quality rule.

Public vocabularies read a text: characters per token under a byte-level and
under a piece vocabulary, the share of the piece vocabulary's tokens that are
bytes it fell back to, and the entropy of the byte-level tokens.  Text that is
not the language it claims, has been mangled or repeats itself leaves the band
of its language, or of its script where the language has none.

The bands are parameters, so a document's verdict doesn't depend on its
neighbours and one pass without a shuffle decides.  The lower bounds of the four
languages lie between what the vocabularies make of running text (articles of
pages, which are not documents) and of the same words between symbols, in
capitals or as cells of tables; those of scripts, for text of unknown language,
are wide.  A text may lack ODD characters at a lower bound or have them beyond an
upper one, and FELL of its pieces may be bytes, so that a short one with a secret,
an identifier or a sign stays.  A text of n tokens can have log2(n) bits at most,
so the bound on entropy is that share of log2(n) which it is of FULL tokens' up to
there.  All of this holds at every length; nothing is accepted unmeasured.

Defined results: a null, empty or white text has no tokens; its measures are
null and it is rejected as ``no_tokens``.  A null language goes by script; rows
that repeat are measured each; a text however long is one text.  Of several
reasons the first in the order of ``verdict`` is named.  Other columns are
ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import units as U
from . import words as W
from .exchange import tidy

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
ODD, FELL, FULL = 64, 4, 64
#: least and most characters per token (byte-level, piece), most byte-fallback share, least entropy in bits
BANDS = {
    "en": (2.48, 7.5, 2.45, 7.0, 0.05, 4.75),
    "de": (2.27, 6.5, 2.47, 6.5, 0.05, 4.75),
    "fr": (2.10, 6.5, 2.20, 6.5, 0.05, 4.75),
    "es": (2.02, 6.5, 2.19, 6.5, 0.05, 4.75),
    "script:latin": (1.5, 7.5, 1.5, 7.0, 0.10, 4.5),
    "script:cyrillic": (0.5, 4.0, 1.2, 6.0, 0.10, 4.0),
    "script:arabic": (0.4, 3.0, 0.6, 4.0, 0.30, 4.0),
    "script:cjk": (0.3, 2.0, 0.4, 2.5, 0.60, 4.0),
    "script:other": (0.2, 8.0, 0.2, 8.0, 1.00, 3.0),
}
#: Lead bytes of UTF-8 that tell a script; the commonest among a text's letters names it.
_SCRIPT = np.full(256, -1, np.int8)
_SCRIPT[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 0
_SCRIPT[0xD0:0xD4] = 1
_SCRIPT[0xD8:0xDC] = 2
_SCRIPT[0xE3:0xEE] = 3
_SCRIPT[[*range(0xCA, 0xD0), *range(0xD4, 0xD8), *range(0xDC, 0xE3), *range(0xEE, 0xF5)]] = 4
_NAMES = ["latin", "cyrillic", "arabic", "cjk", "other"]

MEASURES = ["chars_per_token", "chars_per_piece", "fallback_share", "token_entropy"]
SCHEMA = "n_tokens bigint, n_pieces bigint, chars_per_token double, chars_per_piece double, fallback_share double, token_entropy double, script string"


def _per_doc(values: np.ndarray, start: np.ndarray, off: np.ndarray) -> np.ndarray:
    ends = np.concatenate([[0], np.cumsum(values)])
    return np.diff(ends[np.searchsorted(start, off)])


def measure(text: pa.Array, enc, sp, is_byte: np.ndarray, memo: U.Memo) -> pa.RecordBatch:
    """The measures of each text of a chunk."""
    docs = len(text)
    raw, off, start, end = U.byte_units(text)
    h = U.hashes(raw, start, end)
    u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    ids = list(map(enc.encode_ordinary, U.strings(raw, start[first], end[first])))
    many = np.fromiter(map(len, ids), np.int64, len(ids))
    flat, at = np.fromiter(chain.from_iterable(ids), np.int64, int(many.sum())), np.concatenate([[0], np.cumsum(many)])
    tokens = _per_doc(many[inverse], start, off)
    # Entropy needs the tokens of every unit of every document: one sort of (document, token).
    per = many[inverse]
    ends = np.cumsum(per)
    key = flat[np.arange(per.sum()) - np.repeat(ends - per - at[inverse], per)] + (np.repeat(np.arange(docs), tokens) << 20)
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    bits = np.bincount(key[new] >> 20, count * np.log2(count), docs) if len(key) else np.zeros(docs)
    raw2, _, start2, end2 = U.piece_units(text)
    u2, first2, inverse2 = np.unique(U.hashes(raw2, start2, end2), return_index=True, return_inverse=True)

    def pieces(at):
        got = sp.encode(U.strings(raw2, start2[at], end2[at]), num_threads=1)
        size = np.fromiter(map(len, got), np.int64, len(got))
        fell = np.concatenate([[0], np.cumsum(is_byte[np.fromiter(chain.from_iterable(got), np.int64, int(size.sum()))])])
        ends = np.concatenate([[0], np.cumsum(size)])
        return np.stack([size, np.diff(fell[ends])], 1)

    known = memo.get(u2, first2, pieces)[inverse2]
    n_pieces, n_bytes = _per_doc(known[:, 0], start2, off), _per_doc(known[:, 1], start2, off)
    letters = (raw & 0xC0) != 0x80
    chars = np.diff(np.concatenate([[0], np.cumsum(letters)])[off])
    kinds = np.stack([np.diff(np.concatenate([[0], np.cumsum(_SCRIPT[raw] == k)])[off]) for k in range(5)])
    white = np.diff(np.concatenate([[0], np.cumsum(~U._SPACE[raw])])[off]) == 0
    none = (tokens == 0) | white

    def over(a, b):
        return pa.array(a / np.maximum(b, 1), mask=none)

    entropy = pa.array(np.maximum(np.log2(np.maximum(tokens, 1)) - bits / np.maximum(tokens, 1), 0.0), mask=none)
    script = [_NAMES[k] for k in kinds.argmax(0)]
    return [pa.array(tokens), pa.array(n_pieces), over(chars, tokens), over(chars, n_pieces), over(n_bytes, n_pieces), entropy, pa.array(script)]


def _run(names: list[str], text_col: str, byte_path: str, piece_path: str):
    def run(batches):
        enc, sp = U.byte_encoder(byte_path), U.piece_encoder(piece_path)
        is_byte = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
        memo = U.Memo(2)
        for chunk in W.chunks(batches, text_col):
            yield pa.record_batch([*(chunk.column(n) for n in names), *measure(chunk.column(text_col), enc, sp, is_byte, memo)], [*names, *(x.split()[0] for x in SCHEMA.split(", "))])

    return run


def verdict(bands: dict, lang: str = "lang"):
    """Reason of rejection as a column, null for accepted documents."""
    keys = F.create_map(*[x for k, v in bands.items() for x in (F.lit(k), F.array(*map(F.lit, map(float, v))))])
    band = F.coalesce(keys[F.col(lang)], keys[F.concat(F.lit("script:"), F.col("script"))], keys[F.lit("script:other")])
    full = F.least(F.log2(F.col("n_tokens")) / float(np.log2(FULL)), F.lit(1.0))

    def low(per: str, n: str, least):
        return F.col(per) < least - F.lit(float(ODD)) / F.col(n)

    def high(per: str, n: str, most):
        return F.col(per) > most + F.lit(float(ODD)) / F.col(n)

    return (
        F.when(F.col("chars_per_token").isNull(), "no_tokens")
        .when(F.col("fallback_share") > band[4] + F.lit(float(FELL)) / F.col("n_pieces"), "byte_fallback")
        .when(F.col("token_entropy") < band[5] * full - 1e-9, "entropy_low")
        .when(low("chars_per_token", "n_tokens", band[0]), "chars_per_token_low")
        .when(high("chars_per_token", "n_tokens", band[1]), "chars_per_token_high")
        .when(low("chars_per_piece", "n_pieces", band[2]), "chars_per_piece_low")
        .when(high("chars_per_piece", "n_pieces", band[3]), "chars_per_piece_high")
    )


def tokenizer_fertility(df: DataFrame, bands: dict | None = None, folder: str = U.TOKENIZERS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, measures, reason, accepted) of every document."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    run = _run(["doc_id", "lang"], "text", U.vocabulary(BYTE_VOCABULARY, folder), U.vocabulary(PIECE_VOCABULARY, folder))
    out = docs.mapInArrow(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, {SCHEMA}")
    return out.withColumn("reason", verdict(bands or BANDS)).withColumn("accepted", F.col("reason").isNull())


def _text_inside(run, at: int):
    """run, for batches whose text is field ``at`` of __row and is not sent a second time."""

    def inside(batches):
        return run(pa.record_batch([*b.columns, b.column("__row").field(at)], [*b.schema.names, "__text"]) for b in batches)

    return inside


def keep_fertile(docs: DataFrame, bands: dict | None = None, folder: str = U.TOKENIZERS) -> DataFrame:
    """docs that the bands accept, with their columns as they were."""
    wide = [F.struct(*docs.columns).alias("__row"), F.col("lang").cast("string").alias("__lang")]
    run = _run(["__row", "__lang"], "__text", U.vocabulary(BYTE_VOCABULARY, folder), U.vocabulary(PIECE_VOCABULARY, folder))
    at = docs.columns.index("text") if "text" in docs.columns else [c.lower() for c in docs.columns].index("text")
    if isinstance(docs.schema[at].dataType, StringType):
        run = _text_inside(run, at)
    else:
        wide.append(F.col("text").cast("string").alias("__text"))
    out = docs.select(*wide).mapInArrow(tidy(run), f"__row {docs.schema.simpleString()}, __lang string, {SCHEMA}")
    return out.where(verdict(bands or BANDS, "__lang").isNull()).select("__row.*")
