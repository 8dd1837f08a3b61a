"""Exact n-gram Jaccard self-join through a token-group matrix.

Documents are sets of word n-grams.  Near documents are put in one *group*, and
the matrix stores, for each group, the union of its members' n-grams.  A query Q
can only have a partner of Jaccard t or more in a group that holds at least
ceil(t |Q|) of Q's n-grams, so the other groups are never opened.

The steps, none of which compares all documents with all:

1. every n-gram hash goes once per document to its hash bucket, which returns
   the ones that more than one document has, with their counts.  A document
   whose repeated n-grams are fewer than t |Q| has no partner and is done;
2. documents with equal sets become one class: a row, however many copies it has;
3. groups are the classes of equal minimum hash; those of more than GROUP n-grams
   are cut in parts by hash, which the bound allows because any partition into
   groups is exact;
4. the prefix of Q in order of rising count (|Q| - ceil(t |Q|) + 1 n-grams)
   meets the groups' prefix unions: pairs (Q, group) with nothing in common
   there can't reach t;
5. each remaining query of another group is bounded by |Q n union(group)| with
   the stored union alone;
6. the members of the groups that qualify, or that have several, are shuffled and
   counted exactly.  A task returns a row for each class it found a partner of -
   how many documents it is linked to there, and one class of its component - not
   a row per pair;
7. classes that are linked, directly or through others, get one class id.

Every document is a query; there is no cap on partners, and every link between
different texts is counted.

Defined results: a null or wordless text has no n-grams and no partner; one of
fewer than n words has one n-gram; a null id is a document like any other and
comes after all ids; rows that repeat an id are a document each.  Ids must be
integers or castable to them.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .exchange import binary, blobs, bucket, buckets, chunk_ids, cut, fresh, pack6, release, tidy, tidy_groups, unpack6

N, THRESHOLD, GROUP, QUERIES = 3, 0.55, 2_000_000, 8192
#: Rows of a few numbers that are broadcast (some 20 MB); with more the join is a shuffle.
SLIM = 500_000
#: Stands for a null id inside, so that it comes last.
_LAST = np.iinfo(np.int64).max


def least_overlap(size: np.ndarray, t: float) -> np.ndarray:
    return np.ceil(np.asarray(size) * t - 1e-9).astype(np.int64)


def _doc_sets(text: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each document, and their counts."""
    h, _, _, woff = W.words(text)
    g, off = W.word_ngrams(h, woff, n)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.argsort(g, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")] if len(off) <= 65536 else np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return g[new], np.bincount(doc[new], minlength=len(off) - 1)


def _send(n: int, many: int):
    """Per chunk: a header row, and a row of hashes for each bucket."""

    def run(batches):
        ids = chunk_ids()
        for chunk in W.chunks(batches):
            c = next(ids)
            g, size = _doc_sets(chunk.column("text"), n)
            doc = np.repeat(np.arange(len(size)), size)
            ends = np.zeros(len(g) + 1, np.uint64)
            np.cumsum(W.mix(g + np.uint64(1)), out=ends[1:])
            off = np.concatenate([[0], np.cumsum(size)])
            sig = W.mix(ends[off[1:]] - ends[off[:-1]] + size.astype(np.uint64)).astype(np.int64)
            b = bucket(g, many)
            order = np.argsort(b.astype(np.uint16) if many <= 65536 else b, kind="stable")
            per = np.bincount(b * len(size) + doc, minlength=many * len(size)).reshape(many, -1)
            to, g = np.concatenate([[0], np.cumsum(per.sum(1))]), g[order]
            head = binary(np.stack([chunk.column("doc_id").to_numpy(), chunk.column("version").to_numpy(), size, sig]))
            used = [k for k in range(many) if to[k] < to[k + 1]]
            yield pa.record_batch(
                [
                    pa.array([many + c % many, *used], pa.int64()),
                    pa.array([c] * (1 + len(used)), pa.int64()),
                    pa.array([head, *(pack6(g[to[k] : to[k + 1]]) for k in used)], pa.binary()),
                    pa.array([b"", *(binary(per[k].astype(np.uint32)) for k in used)], pa.binary()),
                ],
                ["bucket", "chunk", "h", "per"],
            )

    return run


def _repeated(many: int):
    """Of one bucket: the hashes of more than one document, for each chunk, with their counts."""

    def run(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() >= many:
            return table.append_column("seen", pa.array([None] * table.num_rows, pa.binary()))
        hs, pers = [unpack6(x) for x in blobs(table["h"], np.uint8)], blobs(table["per"], np.uint32)
        _, inverse, count = np.unique(np.concatenate(hs), return_inverse=True, return_counts=True)
        count, at, out = np.minimum(count, 255).astype(np.uint8), 0, ([], [], [], [])
        for c, h, per in zip(table["chunk"].to_pylist(), hs, pers):
            seen = count[inverse[at : at + len(h)]]
            at += len(h)
            keep = seen > 1
            if keep.any():
                left = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(per, dtype=np.int64)])]
                for o, x in zip(out, (c, pack6(h[keep]), binary(np.diff(left).astype(np.uint32)), binary(seen[keep]))):
                    o.append(x)
        c, *rest = out
        return pa.table({"bucket": pa.array([table["bucket"][0].as_py()] * len(c), pa.int64()), "chunk": pa.array(c, pa.int64()), **{k: pa.array(x, pa.binary()) for k, x in zip(("h", "per", "seen"), rest)}})

    return run


SUSPECT = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("size", pa.int64()), ("sig", pa.int64()), ("near", pa.int64()), ("tokens", pa.binary())])


def _suspects(t: float):
    """Of one chunk: the documents with t |Q| repeated n-grams or more, rarest first; of equal sets the first has the n-grams."""

    def run(table: pa.Table) -> pa.Table:
        seen = table["seen"].to_pylist()
        head = next(np.frombuffer(h, np.int64).reshape(4, -1) for h, s in zip(table["h"].to_pylist(), seen) if s is None)
        body = table.filter(pc.is_valid(table["seen"]))
        if not body.num_rows:
            return SUSPECT.empty_table()
        ids, version, size, sig = head
        # A token is named by its bucket and the low 48 bits of its hash.
        h = np.concatenate([unpack6(x) | np.uint64(b) << np.uint64(48) for b, x in zip(body["bucket"].to_pylist(), blobs(body["h"], np.uint8))])
        seen = np.concatenate(blobs(body["seen"], np.uint8))
        doc = np.concatenate([np.repeat(np.arange(len(ids)), per) for per in blobs(body["per"], np.uint32)])
        many = np.bincount(doc, minlength=len(ids))
        open_ = (many >= least_overlap(size, t)) & (size > 0)
        keep = open_[doc]
        h, seen, doc = h[keep], seen[keep], doc[keep]
        order = np.lexsort((h, seen, doc))
        h, many = h[order], np.where(open_, many, 0)
        at, which = np.concatenate([[0], np.cumsum(many)]), np.flatnonzero(open_)
        parts = [h[at[i] : at[i + 1]] for i in which]
        lead = np.zeros(len(which), bool)
        lead[np.unique(sig[which], return_index=True)[1]] = True
        return pa.table([ids[which], version[which], size[which], sig[which], np.array([int(p.min()) for p in parts], np.uint64).astype(np.int64), pa.array([binary(p) if x else None for p, x in zip(parts, lead)], pa.binary())], schema=SUSPECT)

    return run


def _once(batches):
    """Rows of classes that this partition has not had yet."""
    seen: set[int] = set()
    for batch in batches:
        new = []
        for sig in batch.column("sig").to_pylist():
            new.append(sig not in seen)
            seen.add(sig)
        yield batch.filter(pa.array(new, pa.bool_()))


MATRIX = pa.schema([("grp", pa.int64()), ("near", pa.int64()), ("sig", pa.int64()), ("size", pa.int64()), ("copies", pa.int64()), ("tokens", pa.binary())])


def _matrix(sets: pa.Table, classes: pa.Table) -> pa.Table:
    """Of one group: a row for each class, and one without a class that has the union of their n-grams."""
    if not sets.num_rows:
        return MATRIX.empty_table()
    tokens = dict(zip(sets["sig"].to_pylist(), sets["tokens"].to_pylist()))
    sig = classes["sig"].to_pylist()
    union = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in tokens.values()]))
    rows = pa.table([classes["grp"], classes["near"], classes["sig"], classes["size"], classes["copies"], pa.array([tokens[x] for x in sig], pa.binary())], schema=MATRIX)
    head = pa.table([classes["grp"][:1], classes["near"][:1], pa.array([None], pa.int64()), pa.array([len(union)]), pa.array([len(sig)]), pa.array([binary(union)], pa.binary())], schema=MATRIX)
    return pa.concat_tables([head, rows])


def _slim(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, broadcast while its rows are counted to be SLIM at most: then the n-grams that it meets needn't be shuffled for it."""
    return F.broadcast(table) if table.count() <= SLIM else table


def _prefixes(t: float, index: bool):
    """(token, class, group, size) for each n-gram of a class's prefix; for the index (token, group, least size, greatest size)."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            size, tokens = batch.column("size").to_numpy(), blobs(batch.column("tokens"), np.int64)
            many = np.array([len(x) for x in tokens], np.int64)
            # The n-grams that no other document has come first in the order and need no probe.
            take = np.clip(size - least_overlap(size, t) + 1 - (size - many), 0, many)
            token, grp, size = np.concatenate([x[:k] for x, k in zip(tokens, take)]), np.repeat(batch.column("grp").to_numpy(), take), np.repeat(size, take)
            if not index:
                yield pa.record_batch([token, np.repeat(batch.column("sig").to_numpy(), take), grp, size], ["token", "sig", "grp", "size"])
                continue
            order = np.lexsort((size, grp, token))
            token, grp, size = token[order], grp[order], size[order]
            new = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (grp[1:] != grp[:-1]))) if len(token) else np.zeros(0, np.int64)
            last = np.append(new[1:], len(token))[: len(new)] - 1
            yield pa.record_batch([token[new], grp[new], size[new], size[last]], ["token", "to", "least", "most"])

    return run


QUALIFIED = pa.schema([("grp", pa.int64()), ("sig", pa.int64()), ("size", pa.int64()), ("copies", pa.int64()), ("tokens", pa.binary())])


def _bound(t: float):
    """The queries of one group that its stored union doesn't rule out."""

    def run(union: pa.Table, queries: pa.Table) -> pa.Table:
        if not union.num_rows or not queries.num_rows:
            return QUALIFIED.empty_table()
        have, open_ = blobs(union["union"], np.uint64)[0], []
        for size, q in zip(queries["size"].to_pylist(), blobs(queries["tokens"], np.uint64)):
            at = np.minimum(np.searchsorted(have, q), len(have) - 1)
            open_.append(int((have[at] == q).sum()) >= least_overlap(size, t))
        return queries.select(QUALIFIED.names).filter(pa.array(open_)).cast(QUALIFIED)

    return run


LINK = pa.schema([("sig", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def _verify(t: float):
    """Of one opened group: (class, a class of its component, linked documents) for each class with a partner."""

    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        if not members.num_rows:
            return LINK.empty_table()
        tokens = blobs(members["tokens"], np.uint64)
        union, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
        owner = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
        order = np.argsort(inverse, kind="stable")
        owner, at = owner[order], np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(union)))])
        msig, msize, mcopies = members["sig"].to_numpy(), members["size"].to_numpy(), members["copies"].to_numpy()
        qsig, qsize, qcopies = queries["sig"].to_numpy(), queries["size"].to_numpy(), queries["copies"].to_numpy()
        every, place = np.unique(np.concatenate([msig, qsig]), return_inverse=True)
        mine, theirs = place[: len(msig)], place[len(msig) :]
        links, root = np.zeros(len(every), np.int64), np.arange(len(every))

        def ask(q: np.ndarray, sig: int, size: int, copies: int, me: int, own: bool) -> None:
            pos = np.minimum(np.searchsorted(union, q), len(union) - 1)
            hit = pos[union[pos] == q]
            if len(hit) < least_overlap(size, t):
                return
            first, many = at[hit], at[hit + 1] - at[hit]
            ends = np.cumsum(many)
            both = np.bincount(owner[np.arange(ends[-1]) - np.repeat(ends - many - first, many)], minlength=len(tokens))
            good = np.flatnonzero((both / (size + msize - both) >= t - 1e-12) & ((msig > sig) if own else True))
            if not len(good):
                return
            links[me] += mcopies[good].sum()
            links[mine[good]] += copies
            roots = np.unique(root[np.append(mine[good], me)])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]

        # A group's own members ask too, each in the task of its salt.
        for i in np.flatnonzero(members["asks"].to_numpy(zero_copy_only=False)):
            ask(tokens[i], msig[i], msize[i], mcopies[i], mine[i], True)
        for i, q in enumerate(blobs(queries["tokens"], np.uint64)):
            ask(q, qsig[i], qsize[i], qcopies[i], theirs[i], False)
        found = np.flatnonzero(links)
        return pa.table([every[found], every[root[found]], links[found]], schema=LINK)

    return run


def classes_and_links(df: DataFrame, n: int = N, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents that may have partners (doc_id, version, sig), their classes (sig, copies, least) and what links those (sig, other, links).

    version is a hash of the text; least is the least id of a class.
    """
    spark = df.sparkSession
    many = buckets(spark)
    text = F.col(text_col).cast("string")
    docs = df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(_LAST))).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("version"))
    sent = docs.mapInArrow(tidy(_send(n, many)), "bucket bigint, chunk bigint, h binary, per binary")
    back = sent.groupBy("bucket").applyInArrow(tidy_groups(_repeated(many)), "bucket bigint, chunk bigint, h binary, per binary, seen binary")
    suspects = cut(back.groupBy("chunk").applyInArrow(tidy_groups(_suspects(threshold)), "doc_id bigint, version bigint, size bigint, sig bigint, near bigint, tokens binary"))
    classes = cut(suspects.groupBy("sig", "near", "size").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")))
    # Most minimum hashes have one part; only those with more are looked up.
    parts = classes.groupBy("near").agg(F.ceil(F.sum("size") / GROUP).alias("parts")).where("parts > 1")
    parts = _slim(cut(parts))

    def in_groups(rows: DataFrame) -> DataFrame:
        return rows.join(parts, "near", "left").withColumn("grp", F.xxhash64("near", F.pmod("sig", F.coalesce("parts", F.lit(1))))).drop("parts")

    sets = suspects.where("tokens IS NOT NULL").select("sig", "near", "tokens").mapInArrow(tidy(_once), "sig bigint, near bigint, tokens binary")
    matrix = cut(in_groups(sets).groupBy("grp").cogroup(in_groups(classes).groupBy("grp")).applyInArrow(tidy_groups(_matrix), "grp bigint, near bigint, sig bigint, size bigint, copies bigint, tokens binary"))
    reps = matrix.where("sig IS NOT NULL")
    unions = matrix.where("sig IS NULL").select(F.col("grp").alias("grp"), F.col("copies").alias("members"), F.col("tokens").alias("union"))
    probes = reps.select("sig", "grp", "size", "tokens").mapInArrow(tidy(_prefixes(threshold, False)), "token bigint, sig bigint, grp bigint, size bigint")
    # The index is made of what each batch has once, so only the join's own exchange is needed.
    index = reps.select("grp", "size", "tokens").mapInArrow(tidy(_prefixes(threshold, True)), "token bigint, to bigint, least bigint, most bigint").repartition("token").groupBy("token", "to").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    probed = cut(
        probes.join(index, "token")
        .where((F.col("grp") < F.col("to")) & (F.col("least") * threshold <= F.col("size") + 1e-9) & (F.col("size") * threshold <= F.col("most") + 1e-9))
        .select("sig", F.col("to").alias("grp"))
        .distinct()
    )

    def salted(counts: DataFrame) -> DataFrame:
        """(grp, salts): a group that draws many queries is opened in several tasks, with what they need in each."""
        return counts.select("grp", F.ceil(F.col("queries") / QUERIES).cast("int").alias("salts"))

    def salt(sig: str, salts: str):
        return F.pmod(F.xxhash64(sig), F.col(salts)).cast("int")

    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    salts = _slim(cut(salted(probed.groupBy("grp").agg(F.count("*").alias("queries")))))
    queries = reps.select("sig", "size", "copies", "tokens").join(_slim(cut(probed.join(salts, "grp").select("sig", "grp", salt("sig", "salts").alias("salt")))), "sig")
    stored = unions.select("grp", "union").join(salts, "grp").select("grp", every, "union")
    open_ = cut(stored.groupBy("grp", "salt").cogroup(queries.groupBy("grp", "salt")).applyInArrow(tidy_groups(_bound(threshold)), "grp bigint, sig bigint, size bigint, copies bigint, tokens binary"))
    release(probed)
    # Groups of several members, and those that qualified for a query of another group.
    asked = open_.groupBy("grp").agg(F.count("*").alias("asked"))
    opened = unions.select("grp", "members").join(asked, "grp", "left").where("members > 1 OR asked > 0")
    salts = _slim(cut(salted(opened.select("grp", (F.col("members") + F.coalesce("asked", F.lit(0))).alias("queries")))))
    members = reps.join(salts, "grp").select("grp", every, "sig", "size", "copies", "tokens", salt("sig", "salts").alias("home")).withColumn("asks", F.col("home") == F.col("salt")).drop("home")
    asking = open_.join(salts, "grp").select("grp", salt("sig", "salts").alias("salt"), "sig", "size", "copies", "tokens")
    links = cut(members.groupBy("grp", "salt").cogroup(asking.groupBy("grp", "salt")).applyInArrow(tidy_groups(_verify(threshold)), "sig bigint, other bigint, links bigint"))
    release(open_)
    release(matrix)
    return suspects.select("doc_id", "version", "sig"), classes.select("sig", "copies", "least"), links


def labels(links: DataFrame) -> DataFrame:
    """(sig, root) of every class that is linked to another: root is the least class of its connected component.

    Labels spread by large-star and small-star steps, whose number grows with
    the logarithm of a component's width; each step's edges are a written table.
    """
    edges = cut(links.where("sig <> other").select(F.col("sig").alias("u"), F.col("other").alias("v")))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        last, edges = edges, cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        release(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy(F.col("u").alias("sig")).agg(F.min("v").alias("root"))
        before = now


def near_classes(df: DataFrame, n: int = N, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, class_id, links) of every document that is linked to another; null ids are still the last number."""
    docs, classes, found = classes_and_links(df, n, threshold, id_col, text_col)
    rooted = classes.join(labels(found), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    per = rooted.join(least, "root").join(found.groupBy("sig").agg(F.sum("links").alias("links")), "sig", "left").select("sig", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return docs.join(per.where("links > 0"), "sig").select("doc_id", "version", "class_id", "links")


def ngram_jaccard_join(df: DataFrame, n: int = N, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, links) of every document that has a partner: another one whose word n-gram set has Jaccard ``threshold`` or more with its own.

    links counts the partners, copies too; class_id is the least id among the
    documents that links join, directly or through others.
    """
    def null(c):
        return F.nullif(F.col(c), F.lit(int(_LAST))).alias(c)

    return near_classes(df, n, threshold, id_col, text_col).select(null("doc_id"), null("class_id"), "links")


def drop_near_copies(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the near copies: of each class the document of the least id stays, with its columns as they were.

    Of rows that share that id the one whose text has the least hash stays, and
    of wholly equal texts of that id any one.
    """
    found = cut(near_classes(docs, n, threshold))
    kept = found.groupBy("class_id").agg(F.min(F.struct("doc_id", "version")).alias("kept"))
    marked = found.groupBy("doc_id", "version", "class_id").agg(F.count("*").alias("many")).join(kept, "class_id")
    marked = marked.select("doc_id", "version", "many", (F.struct("doc_id", "version") == F.col("kept")).alias("keep"))
    key, version = fresh(docs, "__key"), fresh(docs, "__version")
    on = (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(_LAST))) == F.col(key)) & (F.xxhash64(F.col("text").cast("string")) == F.col(version))

    def keys(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias(key), F.col("version").alias(version))

    def slim(rows: DataFrame) -> DataFrame:
        """Keys that needn't the texts shuffled to meet them while they are SLIM at most."""
        return _slim(cut(keys(rows)))

    repeated = marked.where("keep AND many > 1")
    if repeated.isEmpty():
        return docs.join(slim(marked.where("NOT keep")), on, "left_anti")
    once = docs.join(slim(repeated), on, "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(slim(marked.where("NOT keep OR many > 1")), on, "left_anti").unionByName(once)
