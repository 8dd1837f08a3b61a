"""Sampling, shuffling, sharding and the allocation of sizes to datasets.

The order of a sample is a hash of the row's id and the seed, so a sample has an
exact size, is the same on any cluster, and can be redone in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def order_key(id_col: str, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def sample_ratio(df: DataFrame, ratios: Column, by: str = "source", id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """floor(n * ratio) rows of each dataset without replacement; a ratio of 1 or more keeps all.

    Only ids are ranked; the rows themselves are joined afterwards.
    """
    w = Window.partitionBy(by)
    ids = df.select(id_col, by, ratios.alias("__r")).withColumn("__n", F.count("*").over(w))
    ids = ids.withColumn("__k", F.row_number().over(w.orderBy(order_key(id_col, seed), id_col)))
    chosen = ids.where((F.col("__r") >= 1) | (F.col("__k") <= F.floor(F.col("__n") * F.col("__r")))).select(id_col)
    return df.join(chosen, id_col, "left_semi")


def check_ratios(df: DataFrame, ratio: str = "ratio") -> DataFrame:
    """df; the query fails on a ratio outside 0 to 1."""
    return df.where(F.assert_true(F.col(ratio).between(0, 1)).isNull())


def sample_rows(df: DataFrame, k: int, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    return df.orderBy(order_key(id_col, seed), id_col).limit(k)


def shuffle(df: DataFrame, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    return df.orderBy(order_key(id_col, seed), id_col)


def round_robin(row: Column, shards: int) -> Column:
    return F.pmod(row, F.lit(shards))


def contiguous(row: Column, rows: Column, shards: int) -> Column:
    """Shard of row number 0..rows-1 in ranges whose sizes differ by one at most, larger ones first."""
    small, more = F.floor(rows / shards), F.pmod(rows, F.lit(shards))
    edge = more * (small + 1)
    return F.when(row < edge, F.floor(row / (small + 1))).otherwise(more + F.floor(F.try_divide(row - edge, small))).cast("bigint")


def shard_count(df: DataFrame, most_bytes: int, text: str = "text") -> DataFrame:
    """One row: how many shards of at most so many bytes the text needs, and no more than rows."""
    return df.agg(F.least(F.greatest(F.ceil(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) / most_bytes), F.lit(1)), F.greatest(F.count("*"), F.lit(1))).alias("shards"))


def water_level(sizes: DataFrame, target: float | Column, size: str = "size", by: list[str] | None = None) -> DataFrame:
    """sizes with level: what each set gives so that together they give the target, none more than it has and the full ones equally.

    Closed form: with sizes in rising order the level is (target - sum of the
    smaller ones) / (number of the others), at the first set it doesn't exceed.
    """
    target = F.lit(float(target)) if not isinstance(target, Column) else target
    group = Window.partitionBy(*(by or [F.lit(1)]))
    up = group.orderBy(size, *[c for c in sizes.columns if c != size and c not in (by or [])]).rowsBetween(Window.unboundedPreceding, -1)
    n = F.count("*").over(group)
    below, rank = F.coalesce(F.sum(size).over(up), F.lit(0)), F.count("*").over(up)
    step = sizes.withColumn("__even", (target - below) / (n - rank))
    level = F.coalesce(F.min(F.when(F.col("__even") <= F.col(size), F.col("__even"))).over(group), F.max(size).over(group))
    return step.withColumn("level", F.least(level.cast("double"), F.col(size).cast("double"))).drop("__even")


def water_level_steps(sizes: list[int], target: int) -> list[int]:
    """The same for a short list in whole numbers: each step gives the smallest set left an equal share and one more."""
    out, left = [0] * len(sizes), target
    order = sorted(range(len(sizes)), key=lambda i: sizes[i])
    for k, i in enumerate(order):
        out[i] = min(sizes[i], math.floor(left / (len(order) - k)) + 1)
        left -= out[i]
    return out


def alpha_shares(sizes: DataFrame, alpha: float = 0.3, size: str = "size") -> DataFrame:
    """sizes with share: the size's share to the power alpha, made to sum to 1."""
    whole = Window.partitionBy(F.lit(1))
    p = F.pow(F.col(size) / F.sum(size).over(whole), F.lit(alpha))
    return sizes.withColumn("__p", p).withColumn("share", F.col("__p") / F.sum("__p").over(whole)).drop("__p")


def scarcest(shares: DataFrame, size: str = "size") -> DataFrame:
    """The row whose size allows the smallest total at its share."""
    return shares.withColumn("total", F.col(size) / F.col("share")).orderBy("total", *shares.columns).limit(1)


def capped(sizes: DataFrame, cap: float, size: str = "size", by: str = "lang") -> DataFrame:
    """Levels of the datasets of each language, whose total is at most the cap."""
    whole = F.sum(size).over(Window.partitionBy(by))
    return water_level(sizes, F.least(whole.cast("double"), F.lit(float(cap))), size, [by])


def oversample(df: DataFrame, by: str, id_col: str) -> DataFrame:
    """Rows of each group repeated in order until all groups are as many as the largest."""
    w = Window.partitionBy(by)
    n = df.select(by).groupBy(by).agg(F.count("*").alias("__n"))
    most = n.agg(F.max("__n").alias("__m"))
    ranked = df.withColumn("__k", F.row_number().over(w.orderBy(id_col)) - 1).join(n, by).crossJoin(F.broadcast(most))
    times = (F.floor(F.col("__m") / F.col("__n")) + F.when(F.col("__k") < F.pmod("__m", "__n"), 1).otherwise(0)).cast("int")
    return ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).drop("__k", "__n", "__m")
