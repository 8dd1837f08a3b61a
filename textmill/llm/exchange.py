"""Helpers shared by the operators of this subpackage: packed exchanges and cut lineage.

Operators that look at every word of a corpus don't make one Spark row per
word.  A Python worker packs what a chunk of documents has to say to one bucket
of the hash space into one binary row, so that the JVM moves a few large rows
and numpy does the work on both sides of the shuffle.
"""

from __future__ import annotations

import ctypes
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..functions.lineage import release, written as cut  # noqa: F401 - the operators take them from here


def pack6(h: np.ndarray) -> bytes:
    """The low six bytes of each hash; the bucket has the top bits."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack6(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = x.reshape(-1, 6)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it that df has no column of."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def buckets(spark: SparkSession) -> int:
    """A power of two of hash buckets, twice the shuffle partitions or more."""
    return 1 << (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each hash by its top bits; n is a power of two."""
    return (h >> np.uint64(65 - n.bit_length())).astype(np.int64) if n > 1 else np.zeros(len(h), np.int64)


def chunk_ids():
    """Numbers for the chunks of this task that no other task of the stage gives."""
    task = TaskContext.get()
    at = (task.partitionId() if task else os.getpid()) << 32
    while True:
        yield at
        at += 1


def binary(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def blobs(col: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    """Each binary value of a column as an array."""
    return [np.frombuffer(b, dtype) for part in (col.chunks if isinstance(col, pa.ChunkedArray) else [col]) for b in (x.as_buffer() for x in part)]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def give_back() -> None:
    """Hand what this worker has freed back to the system: the allocators keep it, and workers live on from step to step beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def tidy(run):
    """The function of mapInArrow, whose worker gives back memory when a task's batches are done."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_groups(f, least: int = 1 << 20):
    """The function of applyInArrow on one table or two, whose worker gives back memory after groups of so many bytes."""

    def one(t: pa.Table) -> pa.Table:
        out = f(t)
        if t.nbytes >= least:
            give_back()
        return out

    def two(t: pa.Table, other: pa.Table) -> pa.Table:
        out = f(t, other)
        if t.nbytes + other.nbytes >= least:
            give_back()
        return out

    return two if f.__code__.co_argcount == 2 else one
