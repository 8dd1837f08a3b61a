"""Nearest neighbours of a stated set of queries among all vectors, by vantage-point trees in shards.

Vectors go to the cell of their nearest pivot, and a cell that holds too many
is cut in shards by hash.  Each shard builds a vantage-point tree of all its
vectors.  A query searches its own shard first, which gives it a radius; then
only the shards that the triangle inequality can't rule out for that radius are
sent the query, and it goes down their trees with the radius it has.

A subtree is left out when ``factor`` times its lower bound exceeds the radius.
Factor 1 is exact search; larger factors visit less and may miss neighbours.

Queries are the vectors whose id is divisible by ``every``; 1 makes every vector
a query.  Every vector is indexed.  Pivots are a sample of at most PIVOTS
vectors, the only thing that all tasks hold; beyond that cells are cut further
instead.  A batch is compared with the pivots in slices of ROUTE distances.

Defined results: rows of null id or null vector, of a length other than the
commonest (the least of equals) or with a value that is null, NaN or infinite
take no part; equal distances go by id; rows that repeat an id are one vector's
worth of result, made from all of them, and are not neighbours of each other; fewer
than k others give fewer neighbours.  Ids must be integers or castable to them.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import cut

K, FACTOR, SHARD, PIVOTS, LEAF, QUERIES, EVERY, ROUTE = 10, 4.0, 8192, 4096, 256, 16384, 100, 2_000_000


def _vectors(col, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of a to each of b, up to rounding."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


class VPTree:
    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.x, self.ids, self.nodes = x, ids, []
        self.root = self._build(np.argsort(ids, kind="stable"), leaf)
        self.scale = float((x * x).sum(1).max(initial=0.0))

    def _build(self, at: np.ndarray, leaf: int) -> int:
        """Nodes are (points,) or (vantage, inner, outer, bounds of both distances)."""
        todo, me = [(at, None, 0)], len(self.nodes)
        while todo:
            at, parent, side = todo.pop()
            k = len(self.nodes)
            if parent is not None:
                self.nodes[parent][side] = k
            x = self.x[at]
            far = x - x.mean(0) if len(at) else x
            vantage = int((far * far).sum(1).argmax()) if len(at) else 0
            d = np.sqrt(((x - x[vantage]) ** 2).sum(1)) if len(at) else np.zeros(0)
            mu = np.median(d) if len(d) else 0.0
            inner = d <= mu
            if len(at) <= leaf or inner.all():
                self.nodes.append([at])
                continue
            self.nodes.append([x[vantage], -1, -1, (d[inner].min(), d[inner].max(), d[~inner].min(), d[~inner].max()), mu])
            todo += [(at[~inner], k, 2), (at[inner], k, 1)]
        return me

    def search(self, q: np.ndarray, own: np.ndarray, radius: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(distances, ids) of up to k points within each query's radius, nearest first; inf and -1 where there are fewer."""
        best, who, tau = np.full((len(q), k), np.inf), np.full((len(q), k), -1, np.int64), radius.astype(float).copy()
        slack = 1e-7 * (1 + np.sqrt(max(self.scale, float((q * q).sum(1).max(initial=0.0)))))

        def leaf(at: np.ndarray, w: np.ndarray) -> None:
            for lo in range(0, len(w), 2048):
                v = w[lo : lo + 2048]
                near = distances(q[v], self.x[at])
                near[self.ids[at][None] == own[v, None]] = np.inf
                edge = tau[v]
                if len(at) > k:  # nothing beyond the k-th of this leaf can count; ties with it still do
                    edge = np.minimum(edge, np.partition(near, k - 1, axis=1)[:, k - 1])
                row, col = np.nonzero(near <= edge[:, None] + slack)
                if not len(row):
                    continue
                d = np.sqrt(((q[v[row]] - self.x[at[col]]) ** 2).sum(1))
                ok = (d <= tau[v[row]]) & (self.ids[at[col]] != own[v[row]])
                row, d, i = row[ok], d[ok], self.ids[at[col[ok]]]
                rows = np.unique(row)
                u = v[rows]
                row = np.concatenate([np.repeat(np.arange(len(u)), k), np.searchsorted(rows, row)])
                d, i = np.concatenate([best[u].ravel(), d]), np.concatenate([who[u].ravel(), i])
                order = np.lexsort((d, i, row))
                row, d, i = row[order], d[order], i[order]
                once = np.append(True, (row[1:] != row[:-1]) | (i[1:] != i[:-1])) | np.isinf(d)  # a repeated id counts once
                row, d, i = row[once], d[once], i[once]
                order = np.lexsort((i, d, row))
                row, d, i = row[order], d[order], i[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                keep = rank < k
                best[u[row[keep]], rank[keep]], who[u[row[keep]], rank[keep]] = d[keep], i[keep]
                tau[u] = np.minimum(tau[u], best[u, -1])

        def down(k: int, w: np.ndarray) -> None:
            if not len(w):
                return
            node = self.nodes[k]
            if len(node) == 1:
                leaf(node[0], w)
                return
            point, inner, outer, (a, b, c, e), mu = node
            d = np.sqrt(((q[w] - point) ** 2).sum(1))
            low = {inner: np.maximum(np.maximum(a - d, d - b), 0) * factor - slack, outer: np.maximum(np.maximum(c - d, d - e), 0) * factor - slack}
            near = d <= mu
            for first, second, part in ((inner, outer, near), (outer, inner, ~near)):
                for side in (first, second):
                    down(side, w[part & (low[side] <= tau[w])])

        if len(self.x):
            down(self.root, np.arange(len(q)))
        return best, who


FOUND = "array<struct<distance: double, id: bigint>>"


def _found(best: np.ndarray, who: np.ndarray) -> pa.Array:
    many = ~np.isinf(best)
    ends = np.concatenate([[0], np.cumsum(many.sum(1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(best[many]), pa.array(who[many])], ["distance", "id"]))


def _slices(batches, pivots: int):
    """Batches of so few rows that their distances to all pivots fit a slice."""
    rows = max(1, ROUTE // max(pivots, 1))
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _assign(pivots: np.ndarray):
    def run(batches):
        for b in _slices(batches, len(pivots)):
            d = distances(_vectors(b.column("x"), pivots.shape[1]), pivots)
            cell = d.argmin(1)
            yield pa.record_batch([b.column("id"), b.column("x"), pa.array(cell.astype(np.int64)), pa.array(d[np.arange(len(d)), cell])], ["id", "x", "cell", "d"])

    return run


def _own(dim: int, k: int, factor: float, every: int):
    """The queries of one shard with what they find in it."""

    def run(t: pa.Table) -> pa.Table:
        x, ids = _vectors(t["x"], dim), t["id"].to_numpy()
        ask = np.flatnonzero(ids % every == 0)
        q = t.select(["id", "x", "cell", "shard"]).take(pa.array(ask))
        best, who = VPTree(x, ids).search(x[ask], ids[ask], np.full(len(ask), np.inf), k, factor) if len(ask) else (np.zeros((0, k)), np.zeros((0, k), np.int64))
        return q.append_column("radius", pa.array(best[:, -1])).append_column("found", _found(best, who))

    return run


def _route(pivots: np.ndarray, low: np.ndarray, high: np.ndarray, shards: np.ndarray, factor: float):
    """(cell, shard, id, x, radius) for each other shard that a query's radius may reach."""

    def run(batches):
        between = None
        for b in _slices(batches, len(pivots)):
            if between is None:
                between = distances(pivots, pivots)
            x, cell, shard, radius = _vectors(b.column("x"), pivots.shape[1]), b.column("cell").to_numpy(), b.column("shard").to_numpy(), b.column("radius").to_numpy()
            d = distances(x, pivots)
            home = d[np.arange(len(d)), cell][:, None]
            # A cell is a ring around its pivot, and lies on its side of the plane between the pivots.
            bound = np.maximum(np.maximum(d - high, low - d), 0)
            apart = between[cell]
            np.maximum(bound, np.where(apart > 0, (d * d - home * home) / np.maximum(2 * apart, 1e-30), 0), out=bound)
            row, to = np.nonzero(bound * factor - 1e-6 <= radius[:, None])
            del bound, apart, d
            many = shards[to]
            row, to = np.repeat(row, many), np.repeat(to, many)
            part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            other = (to != cell[row]) | (part != shard[row])
            row, to, part = row[other], to[other], part[other]
            for at in range(0, len(row), 8192):
                r = pa.array(row[at : at + 8192])
                yield pa.record_batch([pa.array(to[at : at + 8192]), pa.array(part[at : at + 8192]), b.column("id").take(r), b.column("x").take(r), b.column("radius").take(r)], ["cell", "shard", "id", "x", "radius"])

    return run


def _other(dim: int, k: int, factor: float):
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        kind = pa.schema([("id", pa.int64()), ("found", pa.list_(pa.struct([("distance", pa.float64()), ("id", pa.int64())])))])
        if not members.num_rows or not queries.num_rows:
            return kind.empty_table()
        tree = VPTree(_vectors(members["x"], dim), members["id"].to_numpy())
        ids = queries["id"].to_numpy()
        best, who = tree.search(_vectors(queries["x"], dim), ids, queries["radius"].to_numpy(), k, factor)
        some = ~np.isinf(best).all(1)
        return pa.table([pa.array(ids[some]), _found(best[some], who[some])], schema=kind)

    return run


def vp_tree_search(df: DataFrame, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 1) -> DataFrame:
    """(vec_id, rank, neighbor_id, distance): the k nearest others, among all vectors, of each whose id ``every`` divides."""
    if factor < 1 or every < 1:
        raise ValueError("factor and every must be 1 or more")
    spark = df.sparkSession
    x = F.col(vector_col).cast("array<double>")
    all_ = df.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x")).where("id IS NOT NULL AND x IS NOT NULL AND size(x) > 0 AND NOT exists(x, v -> v IS NULL OR isnan(v) OR abs(v) = double('inf'))")
    empty = "vec_id bigint, rank int, neighbor_id bigint, distance double"
    sizes = all_.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], empty)
    dim, rows = sizes
    all_ = all_.where(F.size("x") == dim)
    top = all_.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, -(-rows // shard_rows))).collect()
    pivots = np.unique(np.array([r.x for r in top], np.float64), axis=0)
    placed = cut(all_.mapInArrow(_assign(pivots), "id bigint, x array<double>, cell bigint, d double"))
    low, high, shards = np.full(len(pivots), np.inf), np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(F.min("d"), F.max("d"), F.count("*")).collect():  # a row per pivot
        low[r[0]], high[r[0]], shards[r[0]] = r[1], r[2], -(-r[3] // (2 * shard_rows))
    many = F.array(*[F.lit(int(max(s, 1))) for s in shards]) if len(shards) <= 64 else None
    if many is None:
        table = spark.createDataFrame([(i, int(max(s, 1))) for i, s in enumerate(shards)], "cell bigint, many int")
        sharded = placed.join(F.broadcast(table), "cell").withColumn("shard", F.pmod(F.xxhash64("id", "cell"), F.col("many")).cast("bigint")).drop("many")
    else:
        sharded = placed.withColumn("shard", F.pmod(F.xxhash64("id", "cell"), F.element_at(many, (F.col("cell") + 1).cast("int"))).cast("bigint"))
    own = cut(sharded.groupBy("cell", "shard").applyInArrow(_own(dim, k, factor, every), f"id bigint, x array<double>, cell bigint, shard bigint, radius double, found {FOUND}"))
    routed = cut(own.mapInArrow(_route(pivots, low, high, shards, factor), "cell bigint, shard bigint, id bigint, x array<double>, radius double"))
    salts = routed.groupBy("cell", "shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("salts"))
    queries = routed.join(salts, ["cell", "shard"]).select("cell", "shard", F.expr("cast(pmod(xxhash64(id), salts) AS int)").alias("salt"), "id", "x", "radius")
    members = sharded.select("cell", "shard", "id", "x").join(salts, ["cell", "shard"]).select("cell", "shard", F.expr("explode(sequence(0, salts - 1))").alias("salt"), "id", "x")
    more = members.groupBy("cell", "shard", "salt").cogroup(queries.groupBy("cell", "shard", "salt")).applyInArrow(_other(dim, k, factor), f"id bigint, found {FOUND}")
    both = own.select("id", "found").unionByName(more).groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    both = both.withColumn("found", F.expr(f"slice(filter(found, (x, i) -> array_position(found.id, x.id) = i + 1), 1, {k})"))
    return both.select(F.col("id").alias("vec_id"), F.posexplode("found").alias("rank", "n")).select("vec_id", (F.col("rank") + 1).alias("rank"), F.col("n.id").alias("neighbor_id"), F.col("n.distance").alias("distance"))
