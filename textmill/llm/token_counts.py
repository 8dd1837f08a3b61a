"""Token counts of documents from counts of distinct pre-tokens.

A chunk of documents sends each of its distinct pre-tokens once to the
pre-token's hash bucket, together with how often each of its documents has it.
The bucket runs the vocabulary's merges once per distinct pre-token of the whole
corpus, joins the piece counts to the frequencies, and answers with one sum per
document; the sums of all buckets are a document's count.  Token ids are never
kept, and nothing is broadcast.

A pre-token here is a whitespace-delimited run with the space before it, or a
run of white space: a union of the vocabulary's own pre-tokens, so sums are
exact.

Defined results: a null or empty text has 0 tokens; repeated rows are counted
each; a null id stays null.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import units as U
from . import words as W
from .exchange import binary, blobs, bucket, buckets, chunk_ids

VOCABULARY = "byte_bpe_50k.tiktoken"
_COLUMNS = ["bucket", "chunk", "text", "size", "per", "unit", "freq"]
DDL = "bucket bigint, chunk bigint, text binary, size binary, per binary, unit binary, freq binary"


def _send(many: int):
    def run(batches):
        ids = chunk_ids()
        for chunk in W.chunks(batches):
            c, docs = next(ids), chunk.num_rows
            raw, off, start, end = U.byte_units(chunk.column("text"))
            u, first, inverse = np.unique(U.hashes(raw, start, end), return_index=True, return_inverse=True)
            doc = np.searchsorted(off, start, "right") - 1
            pair, freq = np.unique(doc << 32 | inverse, return_counts=True)
            doc, unit = pair >> 32, pair & 0xFFFFFFFF
            b = bucket(u, many)
            lead = np.searchsorted(b, np.arange(many + 1))
            of = b[unit]
            order = np.argsort(of.astype(np.uint16) if many <= 65536 else of, kind="stable")
            per = np.bincount(of * docs + doc, minlength=many * docs).reshape(many, docs)
            at = np.concatenate([[0], np.cumsum(per.sum(1))])
            unit, freq = unit[order] - lead[of[order]], freq[order]
            size = (end - start)[first]
            ends = np.concatenate([[0], np.cumsum(size)])
            text = raw[np.arange(ends[-1]) - np.repeat(ends[:-1] - start[first], size)]
            used = [k for k in range(many) if lead[k] < lead[k + 1]]
            small = np.uint16 if np.diff(lead).max(initial=0) < 65536 else np.uint32
            ids_ = chunk.column("doc_id")
            head = [pa.array([many + c % many], pa.int64()), pa.array([c], pa.int64()), pa.array([binary(ids_.fill_null(0).to_numpy())], pa.binary()), pa.array([binary(ids_.is_valid().to_numpy(zero_copy_only=False))], pa.binary())]
            yield pa.record_batch([*head, *[pa.array([b""], pa.binary())] * 3], _COLUMNS)
            if used:
                body = [[x[ends[lead[k]] : ends[lead[k + 1]]] if x is text else size[lead[k] : lead[k + 1]].astype(np.uint32) for k in used] for x in (text, size)]
                body += [[per[k].astype(np.uint32) for k in used], [unit[at[k] : at[k + 1]].astype(small) for k in used], [np.minimum(freq[at[k] : at[k + 1]], 255).astype(np.uint8) for k in used]]
                # A frequency of 255 or more is followed, at the end, by what exceeds 255.
                for i, k in enumerate(used):
                    f = freq[at[k] : at[k + 1]]
                    body[4][i] = np.concatenate([body[4][i], (f[f >= 255] - 255).astype("<u4").view(np.uint8)])
                yield pa.record_batch([pa.array(used, pa.int64()), pa.array([c] * len(used), pa.int64()), *(pa.array(list(map(binary, x)), pa.binary()) for x in body)], _COLUMNS)

    return run


def _count(many: int, path: str):
    """Of one bucket: a sum per document of each chunk."""
    held: list = []

    def run(t: pa.Table) -> pa.Table:
        if t["bucket"][0].as_py() >= many:
            return t.select(["chunk", "text", "size"])
        if not held:
            held.append(U.byte_encoder(path))
        size = blobs(t["size"], np.uint32)
        raw = np.concatenate(blobs(t["text"], np.uint8))
        end = np.cumsum(np.concatenate(size), dtype=np.int64)
        start = np.concatenate([[0], end[:-1]])
        _, first, inverse = np.unique(U.hashes(raw, start, end), return_index=True, return_inverse=True)
        pieces = np.fromiter((len(held[0].encode_ordinary(x)) for x in U.strings(raw, start[first], end[first])), np.int64, len(first))[inverse]
        out, at = [], 0
        for units, per, unit, freq in zip(size, blobs(t["per"], np.uint32), t["unit"].to_pylist(), blobs(t["freq"], np.uint8)):
            many_ = int(per.sum())
            u = np.frombuffer(unit, np.uint16 if len(unit) == 2 * many_ else np.uint32)
            f = freq[:many_].astype(np.int64)
            f[f == 255] += np.frombuffer(freq[many_:].tobytes(), "<u4")
            ends = np.concatenate([[0], np.cumsum(pieces[at + u.astype(np.int64)] * f)])
            out.append(binary(np.diff(ends[np.concatenate([[0], np.cumsum(per, dtype=np.int64)])]).astype(np.uint32)))
            at += len(units)
        return pa.table({"chunk": t["chunk"], "text": pa.array([None] * len(out), pa.binary()), "size": pa.array(out, pa.binary())})

    return run


def _add(t: pa.Table) -> pa.Table:
    text, size = t["text"].to_pylist(), t["size"].to_pylist()
    ids, valid = next((np.frombuffer(x, np.int64), np.frombuffer(y, bool)) for x, y in zip(text, size) if x is not None)
    total = sum((np.frombuffer(y, np.uint32).astype(np.int64) for x, y in zip(text, size) if x is None), np.zeros(len(ids), np.int64))
    return pa.table({"doc_id": pa.array(ids, mask=~valid), "n_tokens": total})


def token_counts(df: DataFrame, vocabulary: str = VOCABULARY, folder: str = U.TOKENIZERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every document under a byte-level vocabulary."""
    many = buckets(df.sparkSession)
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sums = docs.mapInArrow(_send(many), DDL).groupBy("bucket").applyInArrow(_count(many, U.vocabulary(vocabulary, folder)), "chunk bigint, text binary, size binary")
    return sums.groupBy("chunk").applyInArrow(_add, "doc_id bigint, n_tokens bigint")
