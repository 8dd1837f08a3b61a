"""SimHash near-duplicates: hashing, banded search by Hamming distance, clusters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import release, written

_MARKS = regex.compile(r"\p{P}")
BLOCKS, DISTANCE, WINDOW = 6, 3, 6


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _codes(tokens: list[str]) -> np.ndarray:
    out = np.zeros(len(tokens), np.uint64)
    for i, t in enumerate(tokens):
        c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
        out[i] = np.uint64(int.from_bytes(t.encode()[-8:], "little")) if len(c) <= 2 else _mix(np.cumsum(c.astype(np.uint64) * np.arange(1, len(c) + 1, dtype=np.uint64))[-1:])[0] ^ np.uint64(len(c))
    return out


def simhash(text: str, window: int = WINDOW, tokenization: str = "character", lower: bool = True, drop_marks: bool = True) -> int:
    """64 signed votes of the shingles; the last window is left out, and a text without shingles hashes to 0."""
    text = text.lower() if lower else text
    if tokenization == "punctuation":
        codes = _codes(_MARKS.split(text))
    else:
        text = _MARKS.sub("", text) if drop_marks else text
        if tokenization == "character":
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        elif tokenization == "space":
            codes = _codes(text.split(" "))
        else:
            raise ValueError("tokenization is character, punctuation or space")
    n = len(codes) - window
    if n <= 0:
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = _mix(h + codes[k : k + n] + np.uint64(0x9E3779B97F4A7C15))
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # long texts in parts
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += 2 * bits.sum(0, dtype=np.int64) - len(bits)
    return int(np.packbits(votes > 0, bitorder="little").view(np.int64)[0])


def simhash_column(c: Column, window: int = WINDOW, tokenization: str = "character") -> Column:
    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([None if t is None else simhash(t, window, tokenization) for t in b], index=b.index, dtype="Int64")

    return run(c)


def band_keys(h: Column, blocks: int, distance: int) -> Column:
    """Two hashes within the distance agree in blocks - distance of the blocks: one key for each choice of those."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - distance):
        m = sum(((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in chosen)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return F.array(*[F.xxhash64(F.lit(i), h.bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])


def near_pairs(hashes: DataFrame, blocks: int = BLOCKS, distance: int = DISTANCE) -> DataFrame:
    """(a, b, diff) of all distinct hashes a < b whose bits differ in ``distance`` places or fewer.

    The planner takes the keys for no larger than the hashes and would broadcast
    all of them, so the join says that both sides are shuffled.
    """
    if not distance < blocks <= 64:
        raise ValueError("there must be more blocks than the distance")
    keyed = hashes.select("hash").where("hash IS NOT NULL").distinct().select(F.col("hash"), F.explode(band_keys(F.col("hash"), blocks, distance)).alias("key"))
    a, b = keyed.select(F.col("hash").alias("a"), "key"), keyed.select(F.col("hash").alias("b"), "key")
    diff = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return a.join(b.hint("shuffle_merge"), "key").where("a < b").select("a", "b", diff.cast("int").alias("diff")).where(F.col("diff") <= distance).distinct()


def representative_pairs(docs: DataFrame, pairs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id1, id2, diff, copies1, copies2) with id1 < id2: the least ids behind each two hashes, and how many documents have each hash.

    A row for two hashes however many documents share them; membership is the
    hash column of ``docs``.
    """
    of = docs.where("hash IS NOT NULL").groupBy("hash").agg(F.min(id_col).alias("id"), F.count("*").alias("copies"))
    one, two = (of.select(F.col("hash").alias(h), F.struct("id", "copies").alias(f"__{h}")) for h in "ab")
    both = pairs.join(one, "a").join(two, "b")
    low, high = F.least("__a", "__b"), F.greatest("__a", "__b")
    return both.select(low["id"].alias("id1"), high["id"].alias("id2"), "diff", low["copies"].alias("copies1"), high["copies"].alias("copies2"))


def id_pairs(docs: DataFrame, pairs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id1, id2, diff) with id1 < id2 of the documents behind the hashes.

    Copies make a row for each two of them: where they may be many,
    ``representative_pairs`` says the same in a row for two hashes.
    """
    one, two = docs.select(F.col("hash").alias("a"), F.col(id_col).alias("x")), docs.select(F.col("hash").alias("b"), F.col(id_col).alias("y"))
    return pairs.join(one, "a").join(two, "b").where("x <> y").select(F.least("x", "y").alias("id1"), F.greatest("x", "y").alias("id2"), "diff").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of edges (a, b); the root is the least node that it is connected with.

    Large-star and small-star steps in turn until nothing changes; each step's
    edges are a written table.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Least neighbours are aggregates joined back, so that no task holds all edges of a node of many.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        last, now = now, written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        release(last)
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    leaves = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def clusters(docs: DataFrame, pairs: DataFrame, link_equal: bool = False, id_col: str = "doc_id") -> DataFrame:
    """(id, hash, cluster): the least id of the cluster, -1 for documents in none.

    Equal hashes alone make no cluster unless ``link_equal``.
    """
    linked = docs.join(components(pairs).withColumnRenamed("node", "hash"), "hash", "left").select(F.col(id_col), "hash", "root")
    if link_equal:
        equal = docs.groupBy("hash").agg(F.count("*").alias("__n")).where("__n > 1").select("hash", F.lit(True).alias("__equal"))
        linked = linked.join(equal, "hash", "left").withColumn("root", F.coalesce("root", F.when(F.col("__equal"), F.col("hash")))).drop("__equal")
    least = linked.where("root IS NOT NULL").groupBy("root").agg(F.min(id_col).alias("cluster"))
    return linked.join(least, "root", "left").select(id_col, "hash", F.coalesce("cluster", F.lit(-1).cast("bigint")).alias("cluster"))


def distance_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("diff").agg(F.count("*").alias("pairs"))


def examples(pairs: DataFrame, each: int = 3) -> DataFrame:
    """Up to so many pairs of each distance, the least first."""
    return pairs.withColumn("k", F.row_number().over(Window.partitionBy("diff").orderBy("id1", "id2"))).where(F.col("k") <= each)


def cluster_sizes(found: DataFrame) -> DataFrame:
    """(size, clusters)."""
    return found.where("cluster <> -1").groupBy("cluster").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))
