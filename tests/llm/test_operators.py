"""Operators against brute force, and on the inputs that break things."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import best_fit_packing as packing
from textmill.llm import fertility
from textmill.llm import gumbel_segmentation as gumbel
from textmill.llm import ngram_jaccard_join as near
from textmill.llm import pitman_yor as hpy
from textmill.llm import queries as llm_queries
from textmill.llm import site_templates as sites
from textmill.llm import suffix_array_dedup as suffixes
from textmill.llm import token_counts as counts
from textmill.llm import units as U
from textmill.llm import vp_tree_search as vp
from textmill.llm import words as W
from textmill.llm.host_reputation import host_reputation

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"(?:[A-Za-z0-9_]|[^\x00-\x7f])+")


def documents(seed=0):
    """Small documents with nulls, empties, copies, near copies, ties, odd spaces and one long text."""
    rng = random.Random(seed)
    nouns = "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work number night point home water room mother area money story month study book eye job word issue side kind head house service friend father power hour game line end member law car city name team minute idea body parent face level office door health person art war history party result change morning reason girl moment air teacher force foot boy age policy music market été où".split()
    vocabulary = nouns + [n + "s" for n in nouns]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(60)
    base = text(120).split(" ")
    near_copy = base[:]
    near_copy[7] = near_copy[70] = "changed"
    texts = [text(rng.randint(1, 90)) for _ in range(25)]
    texts += [" ".join(base), " ".join(base), " ".join(near_copy), text(30) + " " + passage + " " + text(20), passage + ". " + text(10), "Ab\n" + passage]
    texts += [None, "", "   ", "\n\n", "one", "one two", "x " * 150, "a b  c　d ▁ e\tf\r\n g", "\U0001f600 中文 \x00 z", text(4000), "!!! ???"]
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [(None, "null id " + text(60), "fr", "s", 1), (None, None, None, None, None), rows[3], rows[26]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).cache()


@pytest.fixture(scope="module")
def clashing(docs):
    """Columns of the names that the operators use inside."""
    names = ("key", "sig", "size", "tokens", "chunk", "bucket", "grp", "kept", "h", "n", "__key", "reason", "n_tokens", "host", "sample")
    return docs.selectExpr("*", *(f"1 AS `{x}`" for x in names))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def word_sets(rows, n):
    out = []
    for r in rows:
        w = WORD.findall((r[1] or "").lower())
        out.append((r[0], frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()))
    return out


def brute_classes(rows, n, threshold):
    """(doc_id, class_id, links) of each row with a partner, from all pairs."""
    sets = word_sets(rows, n)
    root, links = list(range(len(sets))), [0] * len(sets)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and len(x & y) / len(x | y) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(sets):
        have = least.setdefault(find(i), a)
        least[find(i)] = a if have is None or (a is not None and a < have) else have
    return collections.Counter((a, least[find(i)], links[i]) for i, (a, _) in enumerate(sets) if links[i])


@pytest.mark.parametrize("threshold", [0.3, 0.55, 0.9])
def test_jaccard_join_is_exact(docs, clashing, threshold, monkeypatch):
    monkeypatch.setattr(near, "GROUP", 2)
    want = brute_classes(documents(), 3, threshold)
    assert want
    assert collections.Counter(map(tuple, near.ngram_jaccard_join(docs, 3, threshold).collect())) == want
    assert collections.Counter(map(tuple, near.ngram_jaccard_join(clashing, 3, threshold).collect())) == want


def family(copies=60, seed=11):
    """A chain of texts that drift, so that far ones are linked through others only, with copies and bystanders."""
    rng = random.Random(seed)
    w, rows = [f"w{rng.randrange(500)}" for _ in range(80)], []
    for i in range(copies):
        w = w[:]
        for _ in range(2):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows += [(i, " ".join(w)), (1000 + i, " ".join(w))][: 1 + i % 2]
    return rows + [(5000 + i, " ".join(f"u{rng.randrange(300)}" for _ in range(80))) for i in range(40)] + [(None, rows[5][1])]


def test_links_of_a_family_of_unequal_texts(spark, monkeypatch):
    monkeypatch.setattr(near, "GROUP", 8)
    monkeypatch.setattr(near, "QUERIES", 7)
    rows = family()
    want = brute_classes(rows, 3, 0.55)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert len({c for _, c, _ in want}) < 20 < len(want)
    assert collections.Counter(map(tuple, near.ngram_jaccard_join(df, 3, 0.55).collect())) == want


def test_jaccard_join_of_nothing(none):
    assert near.ngram_jaccard_join(none).count() == 0
    assert near.drop_near_copies(none).count() == 0


def test_one_document_of_each_group_stays(spark, docs, clashing):
    kept = near.drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert 25 in ids and 26 not in ids and 27 not in ids
    assert ids[None] == 2 and ids[3] == 1  # of a repeated row one stays, and null ids without partners
    assert {r[0] for r in documents()} - set(ids) == {26, 27, 30}  # 30 is the passage that is most of 29
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (7, text + " end"), (7, text), (None, text), (None, None), (8, "other"), (8, "others")]
    left = near.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left if not (r.text or "").startswith("w0")) == [(0, ""), (8, "other"), (8, "others")]
    assert len(left) == 4 and [r.doc_id for r in left if (r.text or "").startswith("w0")] == [7]


def test_removal_of_near_copies_shuffles_no_text_for_few_keys(spark, docs, monkeypatch):
    """Keys too many for the planner to broadcast, but SLIM at most; and the shuffle of more gives the same rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        for rows in (docs, once):
            few = near.drop_near_copies(rows)
            plan = few._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
            monkeypatch.setattr(near, "SLIM", 0)
            more = near.drop_near_copies(rows)
            assert "SortMergeJoin" in more._jdf.queryExecution().executedPlan().toString()
            assert sorted(few.collect(), key=repr) == sorted(more.collect(), key=repr)
            monkeypatch.undo()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def brute_spans(rows, length):
    """Like the operator: rows equal in id and text are one document, null ids come last."""
    rows = sorted(set((r[0], r[1]) for r in rows if r[1]), key=lambda r: (r[0] is None, r[0] or 0))
    first, count, texts = {}, collections.Counter(), []
    for k, (i, t) in enumerate(rows):
        w = WORD.findall(t)
        texts.append((k, i, w))
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            count[key] += 1
            first.setdefault(key, (k, p))
    out = []
    for k, i, w in texts:
        runs = {True: [], False: []}
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            if count[key] > 1:
                o = first[key]
                kept = o == (k, p)
                lo = max(p, o[1] + length) if o[0] == k and not kept else p
                if runs[kept] and lo <= runs[kept][-1][1]:
                    runs[kept][-1][1] = p + length
                else:
                    runs[kept].append([lo, p + length])
        out += [(i, a, b, kept) for kept, r in runs.items() for a, b in r]
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,q", [(50, 25), (20, 3), (6, 6), (5, 1)])
def test_suffix_array_finds_every_repeat(docs, clashing, length, q):
    want = brute_spans(documents(), length)
    assert want
    assert sorted(map(tuple, suffixes.suffix_array_dedup(docs, length, q).collect()), key=repr) == want
    assert sorted(map(tuple, suffixes.suffix_array_dedup(clashing, length, q).collect()), key=repr) == want


def test_repeats_are_cut_out(docs, clashing, none):
    out = suffixes.drop_repeats(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    texts = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    rows = {r[0]: r[1] for r in documents() if r[0] is not None}
    passage = " ".join(WORD.findall(rows[29])[:60])
    assert passage in texts[28].text and passage not in texts[29].text and texts[30].text == "Ab\n"
    assert texts[26].text == "" and texts[26].n_chars == 0 and texts[25].text == rows[25]
    assert len(WORD.findall(texts[37].text)) == 50  # of "x x x ..." its first window stays
    assert texts[31].text is None and texts[40].text == rows[40]
    assert suffixes.suffix_array_dedup(none).count() == 0 and suffixes.drop_repeats(none).count() == 0


def encoders():
    return U.byte_encoder(U.vocabulary("byte_bpe_50k.tiktoken")), U.piece_encoder(U.vocabulary("piece_bpe_32k.model"))


def test_token_counts_equal_the_tokenizer(docs, clashing, none):
    enc, _ = encoders()
    want = collections.Counter((r[0], len(enc.encode_ordinary(r[1] or ""))) for r in documents())
    assert collections.Counter(map(tuple, counts.token_counts(docs).collect())) == want
    assert collections.Counter(map(tuple, counts.token_counts(clashing).collect())) == want
    assert counts.token_counts(none).count() == 0


def test_fertility_equals_direct_encoding(docs, clashing, none):
    enc, sp = encoders()
    got = {r.doc_id: r for r in fertility.tokenizer_fertility(clashing).collect()}
    assert len(got) and fertility.tokenizer_fertility(docs).count() == len(documents())
    for i, t, *_ in documents():
        if i is None or not (t or "").strip():
            continue
        ids, pieces = enc.encode_ordinary(t), sp.encode(t)
        share = np.unique(ids, return_counts=True)[1] / len(ids)
        r = got[i]
        assert (r.n_tokens, r.n_pieces) == (len(ids), len(pieces))
        assert r.chars_per_token == pytest.approx(len(t) / len(ids))
        assert r.fallback_share == pytest.approx(np.mean([sp.is_byte(p) for p in pieces]))
        assert r.token_entropy == pytest.approx(-(share * np.log2(share)).sum(), abs=1e-9)
    assert all(got[i].reason == "no_tokens" and got[i].token_entropy is None for i in (31, 32, 33, 34))
    assert got[37].reason == "entropy_low" and got[35].accepted
    kept = fertility.keep_fertile(clashing)
    assert kept.columns == clashing.columns and {31, 37}.isdisjoint({r.doc_id for r in kept.collect()})
    assert fertility.keep_fertile(none).count() == 0


def test_fertility_rejects_noise_and_keeps_clean_short_texts(spark):
    parts = "the of and in to is that he ing er on an re th ha ed ou nd at st es en ti or hea nt wh sh ly ble tion ea".split()
    rng = random.Random(4)
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    clean = [" ".join(rng.choice(words) for _ in range(n)) + "." for n in (60, 300, 1500)]
    clean += [f'{clean[0]} token = "46d6a7e6a8a7bb8c02c2f090c991ec47d826f64"']
    plain = [rng.choice(words) for _ in range(600)]
    noise = [" ".join(w + rng.choice("$&#%*") * 3 for w in plain), " ".join(w.upper() + "!!" for w in plain)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean + noise)], "doc_id bigint, text string, lang string")
    reason = {r.doc_id: r.reason for r in fertility.tokenizer_fertility(df).collect()}
    assert [reason[i] for i in range(len(clean))] == [None] * len(clean)
    assert all("chars_per" in (reason[len(clean) + i] or "") for i in range(len(noise)))
    assert {r.doc_id for r in fertility.keep_fertile(df).collect()} == set(range(len(clean)))


def test_bin_completion_is_optimal_on_small_sets():
    def optimum(sizes, capacity):
        best = [len(sizes)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(sizes):
                best[0] = len(bins)
                return
            for k, free in enumerate(bins):
                if free >= sizes[i] and free not in bins[:k]:
                    go(i + 1, [*bins[:k], free - sizes[i], *bins[k + 1 :]])
            go(i + 1, [*bins, capacity - sizes[i]])

        go(0, [])
        return best[0]

    rng, better = random.Random(5), 0
    for _ in range(250):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(0, 9))), reverse=True)
        bins = packing.complete(sizes, 100, 10**6)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
        assert len(bins) == optimum(sizes, 100) >= (packing.lower_bound(sizes, 100) if sizes else 0)
        better += len(packing.best_fit(sizes, 100)) > len(bins)
    sizes = [51, 27, 26, 23, 23, 24, 26]
    sizes.sort(reverse=True)
    assert len(packing.complete(sizes, 100)) <= len(packing.best_fit(sizes, 100))


def test_bin_completion_beats_best_fit_on_groups_of_production_size():
    rng, hard = random.Random(7), 0
    for _ in range(12):
        sizes = sorted((int(rng.lognormvariate(7.2, 0.9)) % packing.CAPACITY + 1 for _ in range(packing.GROUP)), reverse=True)
        bins, least = packing.complete(sizes, packing.CAPACITY), packing.lower_bound(sizes, packing.CAPACITY)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= packing.CAPACITY for b in bins)
        if len(packing.best_fit(sizes, packing.CAPACITY)) > least:
            hard += 1
            assert len(bins) == least
    assert hard > 1


def test_packing_of_thousands_of_equal_rows(spark):
    df = spark.range(5000).selectExpr("7L AS doc_id", "repeat('x', 2800) AS text").unionByName(spark.range(9000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "repeat('y', 100) AS text"))
    out = packing.best_fit_packing(df).groupBy("doc_id").agg({"n_chars": "sum", "bin_id": "count"}).collect()
    assert {(r[0], r[1], r[2]) for r in out} == {(7, 14_000_000, 5000), (None, 900_000, 9000)} or {(r[0], r[2], r[1]) for r in out} == {(7, 14_000_000, 5000), (None, 900_000, 9000)}
    bins = packing.best_fit_packing(df).groupBy("bin_id").sum("n_chars").collect()
    assert max(r[1] for r in bins) <= packing.CAPACITY and len(bins) <= 1.05 * 5000 / 2 + 30
    one = spark.createDataFrame([(1, "z" * 100_000), (2, "z" * 8192)], "doc_id bigint, text string")
    assert packing.best_fit_packing(one).count() == 14


def test_packing_places_every_character_once(docs, clashing, none):
    for df in (docs, clashing):
        seen, used = collections.defaultdict(list), collections.Counter()
        for r in packing.best_fit_packing(df, capacity=256, group=8).collect():
            seen[r.doc_id].append((r.start_char, r.n_chars))
            used[r.bin_id] += r.n_chars
            assert r.bin_chars <= 256
        assert max(used.values()) <= 256
        size = collections.Counter()
        for i, t, *_ in documents():
            size[i] += len(t or "")
        assert {i: sum(n for _, n in x) for i, x in seen.items()} == {i: n for i, n in size.items() if n}
    assert packing.best_fit_packing(none).count() == 0


def enumerate_segmentations(text, sp):
    x, out = "▁" + text.replace(" ", "▁"), []

    def go(i, ids):
        if i == len(x):
            out.append(tuple(ids))
            return
        for j in range(i + 1, len(x) + 1):
            p, k = x[i:j], sp.piece_to_id(x[i:j])
            known = k != 0 and sp.id_to_piece(k) == p and (sp.get_score(k) > -1e8 or p == "▁")
            if "▁" in p[1:]:
                continue
            if known:
                go(j, [*ids, k])
            elif j == i + 1:
                go(j, [*ids, *(b + 3 for b in p.encode())])

    go(0, [])
    return set(out)


@pytest.mark.parametrize("steps", [1, 8])
def test_gumbel_samples_follow_the_law(monkeypatch, steps):
    monkeypatch.setattr(gumbel, "_STEPS", steps)
    pieces, (_, sp), n, k = gumbel.Pieces(U.vocabulary(gumbel.VOCABULARY)), encoders(), 6000, 3
    for text in ("the a", "añ€"):
        every = enumerate_segmentations(text, sp)
        key = W.mix(np.arange(n, dtype=np.uint64) + np.uint64(99))
        doc, sample, ids, many, lp, value, inclusion = gumbel.sample_chunk(pa.array([text] * n), key, pieces, k, 0.2)
        off = np.concatenate([[0], np.cumsum(many)])
        got = [tuple(ids[a:z].tolist()) for a, z in zip(off[:-1], off[1:])]
        p = {g: np.exp(x) for g, x in zip(got, lp)}
        assert set(got) <= every and (len(p) < len(every) or sum(p.values()) == pytest.approx(1))
        assert len(set(zip(doc.tolist(), got))) == len(got) == n * min(k, len(every))
        assert all(np.diff(value[doc == 0]) <= 0)
        first = collections.Counter(g for g, s in zip(got, sample) if s == 0)
        second = collections.Counter(g for g, s in zip(got, sample) if s == 1)
        for b in p:
            assert first[b] / n == pytest.approx(p[b], abs=0.03)
            assert second[b] / n == pytest.approx(sum(p[a] * p[b] / (1 - p[a]) for a in p if a != b), abs=0.035)
        # Samples weighted by probability over inclusion estimate sums over all segmentations without bias.
        assert np.exp(lp - inclusion).sum() / n == pytest.approx(1, abs=0.05)


def test_gumbel_work_is_shared_by_the_documents_of_a_chunk(monkeypatch):
    """Documents go through a round together, and only what begins a piece is looked up as a longer one."""
    pieces, calls, looked = gumbel.Pieces(U.vocabulary(gumbel.VOCABULARY)), [], []
    uniform, find = gumbel._uniform, gumbel.Pieces.find
    monkeypatch.setattr(gumbel, "_uniform", lambda *a: calls.append(1) or uniform(*a))
    monkeypatch.setattr(gumbel.Pieces, "find", lambda self, h: looked.append(len(h)) or find(self, h))
    text = "the people of a small town near the river"

    def work(n):
        calls.clear()
        gumbel.sample_chunk(pa.array([text] * n), W.mix(np.arange(n, dtype=np.uint64)), pieces, 3, 0.5)
        return len(calls)

    # A path of one document may need one split more than another's, so a few calls more are allowed.
    assert work(200) <= work(1) + 8
    looked.clear()
    letters = "☃" * 4000
    gumbel.sample_chunk(pa.array([letters]), W.mix(np.arange(1, dtype=np.uint64)), pieces, 2, 0.5)
    assert sum(looked) < 3 * len(letters)  # not once for each length of a piece


def test_segmentations_decode_to_the_text(docs, clashing, none):
    out = gumbel.gumbel_segmentations(clashing, k=2)
    rows = [r for r in documents() if r[1] is not None]
    back = gumbel.decode(out).collect()
    want = collections.defaultdict(set)
    for r in rows:
        want[r[0]].add(r[1].replace("▁", " "))
    assert all(r.text in want[r.doc_id] for r in back)
    assert {r.doc_id for r in back} == set(want)
    assert collections.Counter(r.doc_id for r in back)[32] == 1  # the empty text has one segmentation
    again = {(r.doc_id, r.sample, tuple(r.ids)) for r in gumbel.gumbel_segmentations(docs.repartition(3), k=2).collect()}
    assert again == {(r.doc_id, r.sample, tuple(r.ids)) for r in out.collect()}
    assert gumbel.gumbel_segmentations(none).count() == 0


def vectors(n=300, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + 4 * rng.integers(0, 3, size=(n, 1))
    x[10] = x[11] = x[12]
    return [(i, x[i].tolist()) for i in range(n)]


def true_neighbours(rows, k):
    x, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    return {int(i): [int(ids[j]) for j in np.lexsort((ids, d[a])) if ids[j] != i][:k] for a, i in enumerate(ids)}


def neighbours(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("vec_id", "rank").collect():
        out[r.vec_id].append(r.neighbor_id)
    return dict(out)


def test_vp_trees_are_exact_at_factor_one_and_near_beyond(spark, monkeypatch):
    monkeypatch.setattr(vp, "LEAF", 4)
    rows = vectors()
    odd = [(None, rows[0][1]), (900, None), (901, [1.0]), (902, [float("nan")] * 8), (903, [None] * 8)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS id", "2 AS cell", "3 AS shard")
    want = true_neighbours(rows, 5)
    assert neighbours(vp.vp_tree_search(df, 5, 1.0, shard_rows=40)) == want
    near_ = neighbours(vp.vp_tree_search(df, 5, vp.FACTOR, shard_rows=40))
    assert np.mean([len(set(want[i]) & set(near_.get(i, []))) / 5 for i in want]) >= 0.9


def test_vp_search_of_the_stated_queries(spark, monkeypatch):
    monkeypatch.setattr(vp, "ROUTE", 20)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = {i: n for i, n in true_neighbours(rows, 5).items() if i % 7 == 0}
    assert neighbours(vp.vp_tree_search(df, 5, 1.0, shard_rows=40, every=7)) == want


def test_recall_of_the_registered_search(spark):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    x, ids = np.array(table["embedding"].to_pylist(), float), table["vec_id"].to_numpy()
    got = neighbours(llm_queries.op1_vp_tree_search(spark, "/root/testdata/sf0.1"))
    asked, hits = np.flatnonzero(ids % 100 == 0), []
    for q in asked:
        d = np.where(np.arange(len(x)) == q, np.inf, ((x - x[q]) ** 2).sum(1))
        hits.append(len(set(ids[np.argsort(d)[:10]]) & set(got[ids[q]])) / 10)
    assert set(got) == set(ids[asked]) and np.mean(hits) >= 0.9


def test_vp_trees_of_few_or_no_vectors(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert vp.vp_tree_search(spark.createDataFrame([], kind)).count() == 0
    assert vp.vp_tree_search(spark.createDataFrame([(1, [1.0, 2.0])], kind)).count() == 0
    assert neighbours(vp.vp_tree_search(spark.createDataFrame([(1, [0.0]), (2, [0.0]), (-3, [5.0])], kind), 2)) == {1: [2, -3], 2: [1, -3], -3: [1, 2]}
    twice = spark.createDataFrame([(1, [0.0]), (1, [1.0]), (2, [3.0])], kind)
    assert neighbours(vp.vp_tree_search(twice, 2)) == {1: [2], 2: [1]}
    with pytest.raises(ValueError):
        vp.vp_tree_search(twice, factor=0.5)


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    alphabet = np.arange(97, 103)
    text = rng.choice(alphabet, 2000, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.1])
    rows = np.stack([text[k : len(text) - 2 + k] for k in range(3)], 1).astype(np.uint32)
    rows, count = np.unique(rows, axis=0, return_counts=True)
    for x in (97, 98):
        at = rows[:, 1] == x
        shard = hpy.Shard(rows[at], count[at], np.full(at.sum(), 1 / 6), 0.6, 1.0)
        for _ in range(3):
            shard.sweep(rng)
            assert all((t >= np.minimum(c, 1)).all() and (t <= c).all() for c, t in zip(shard.c, shard.t))
            assert (shard.c[1] == np.bincount(shard.levels[0][1], shard.t[0])).all()
        p = shard.predictive()
        rest, up = shard.levels[0]
        for r in np.unique(rest):
            dishes = np.flatnonzero(rest == r)
            c, t = shard.c[0][dishes].sum(), shard.t[0][dishes].sum()
            parent = p[1][up[dishes]].sum()
            missing = (1.0 + 0.6 * t) / (1.0 + c) * (1 - parent)  # what unseen dishes have
            assert p[0][dishes].sum() + missing == pytest.approx(1, abs=1e-9)


def test_table_draws_follow_the_stirling_law():
    rng, n, c, d, strength, others, parent = np.random.default_rng(1), 20000, 5, 0.5, 1.0, 3, 0.2
    t = hpy.draw_tables(np.full(n, c), np.full(n, others), np.full(n, parent), d, strength, rng)
    # Brute force: every seating of 5 customers, built customer by customer.
    weight = collections.Counter()

    def seat(k, tables, w):
        if k == c:
            weight[len(tables)] += w
            return
        for i, s in enumerate(tables):
            seat(k + 1, [*tables[:i], s + 1, *tables[i + 1 :]], w * (s - d))
        seat(k + 1, [*tables, 1], w * (strength + d * (others + len(tables))) * parent)

    seat(0, [], 1.0)
    total = sum(weight.values())
    for k, w in weight.items():
        assert (t == k).mean() == pytest.approx(w / total, abs=0.015)


@pytest.mark.parametrize("d", [0.05, 0.5, 0.75, 0.9])
def test_table_draws_of_many_customers_have_the_same_law(d):
    many, strength, others, parent = hpy.KNOWN + 200, 1.0, 40, 0.2
    exact = np.full((many + 1, many + 1), -np.inf)
    exact[0, 0], t = 0.0, np.arange(many + 1)
    for c in range(many):
        stay = exact[c] + np.log(np.maximum(c - t * d, 1e-300))
        exact[c + 1] = np.logaddexp(np.append(-np.inf, exact[c, :-1]), np.where(t > c, -np.inf, stay))
    for c in (hpy.TABLE + 1, many):
        k = np.arange(1, c + 1)
        assert np.abs(hpy.far_stirling(np.full(c, c), k, d) - exact[c, k]).max() < 0.012
        assert np.abs(hpy.log_stirling(np.full(c, c), k, d) - exact[c, k]).max() < (1e-9 if c <= hpy.KNOWN else 0.012)
        lw = exact[c, k] + np.cumsum(np.log(strength + d * (others + k - 1))) + k * np.log(parent)
        want = np.exp(lw - lw.max()) / np.exp(lw - lw.max()).sum()
        n, rng = 3000, np.random.default_rng(c)
        now = np.ones(n, np.int64)
        for _ in range(4):
            now = hpy.draw_tables(np.full(n, c), np.full(n, others), np.full(n, parent), d, strength, rng, now)
        assert now.min() >= 1 and now.max() <= c
        assert np.abs(np.cumsum(np.bincount(now, minlength=c + 1)[1:] / n) - np.cumsum(want)).max() < 0.04


def direct_chain(texts, shard_of, order, burn_in, sweeps, seed):
    """Log probability of each text (a list of symbols), by the same chain without Spark: all n-grams in dictionaries, one process."""
    padded = [[2] * (order - 1) + t + [3] for t in texts]
    count = collections.Counter(tuple(x[i : i + order]) for x in padded for i in range(len(x) - order + 1))
    shards = {}
    for v in sorted({shard_of(g[-2]) for g in count}):
        rows = np.array(sorted((g for g in count if shard_of(g[-2]) == v), key=lambda g: g[::-1]), np.uint32)
        shards[v] = (rows, hpy.Shard(rows, np.array([count[tuple(map(int, r))] for r in rows]), np.zeros(len(rows)), 0.7, 1.0))
    rng, root, d, strength = np.random.default_rng(seed), hpy.Root(0.7, 1.0), [0.7] * (order - 1), [1.0] * (order - 1)
    customers = collections.Counter()
    for v, w in {g[-2:] for g in count}:
        customers[w] += 1
    total = {v: np.zeros(len(rows)) for v, (rows, _) in shards.items()}
    for number in range(burn_in + sweeps):
        base, rest = root.sweep(dict(customers), rng)
        assert sum(base.values()) + rest == pytest.approx(1)
        sums, customers = [np.zeros(5) for _ in d], collections.Counter()
        for v, (rows, s) in shards.items():
            own = np.random.default_rng([seed, number, v])
            s.base, s.d, s.strength = np.array([base.get(int(r[-1]), rest) for r in rows]), d, strength
            s.sweep(own)
            if number >= burn_in:
                total[v] += s.predictive()[0]
            for k, (r, _) in enumerate(s.levels):
                c, t = np.bincount(r, s.c[k]).astype(int), np.bincount(r, s.t[k]).astype(int)
                sums[k] += [*hpy.strength_sums(c, t, d[k], strength[k], own), len(c), (s.c[k] == 1).sum(), (s.c[k] == 2).sum()]
            for i, n in zip(s.top, s.t[-1]):
                customers[int(rows[i][-1])] += int(n)
        strength = []
        for x in sums:
            strength.append(hpy.draw_strength(x[0], int(x[1]), int(x[2]), rng))
        d = [hpy.counted_discount(int(x[3]), int(x[4])) for x in sums]
    p = {tuple(map(int, g)): total[v][i] / sweeps for v, (rows, _) in shards.items() for i, g in enumerate(rows)}
    return [sum(np.log(p[tuple(x[i : i + order])]) for i in range(len(x) - order + 1)) for x in padded]


def test_log_probabilities_against_a_direct_chain(spark):
    order, burn_in, sweeps, seed = 3, 1, 3, 5
    texts = ["abab cab", "abab cab", "", "bca", "aé b" * 5]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in hpy.pitman_yor_perplexity(df, order, 0.7, 1.0, burn_in, sweeps, seed).collect()}
    for k, want in enumerate(direct_chain([list(map(ord, t)) for t in texts], lambda v: v, order, burn_in, sweeps, seed)):
        assert got[k].log_prob == pytest.approx(want, rel=1e-5) and got[k].perplexity == pytest.approx(np.exp(-want / (len(texts[k]) + 1)), rel=1e-5)


def test_log_probabilities_of_pieces_against_a_direct_chain(spark):
    order, burn_in, sweeps, seed = 3, 1, 2, 7
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "Überraschung", "日本"]) for _ in range(rng.randrange(30))) for _ in range(30)]
    texts += ["", None, "  two  blanks ", "the " * 80, texts[0], "line\nline\u2003wide"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in hpy.pitman_yor_perplexity(df, order, 0.7, 1.0, burn_in, sweeps, seed, vocabulary=hpy.VOCABULARY).collect()}
    sp = U.piece_encoder(U.vocabulary(hpy.VOCABULARY))
    symbols = [[i + 4 for i in sp.encode(t or "")] for t in texts]
    shards = hpy.SHARDS * hpy.buckets(spark)
    want = direct_chain(symbols, lambda v: int(hpy.bucket(hpy.W.mix(np.array([v], np.uint64)), shards)[0]), order, burn_in, sweeps, seed)
    assert len(got) == len(texts)
    for k, (lp, x) in enumerate(zip(want, symbols)):
        assert got[k].events == len(x) + 1 and got[k].log_prob == pytest.approx(lp, rel=1e-5)


def test_a_worker_of_the_perplexity_holds_little_beside_a_chunk():
    """Peaks over two full chunks of 3 MB; they were 97 and 90 MB when arrays outlived their chunk."""
    rng = np.random.default_rng(0)
    syllables = [a + b for a in "bcdfglmnprstv" for b in ("a", "e", "i", "o", "u", "an", "er")]
    vocabulary = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(40_000)]
    at = rng.zipf(1.2, 1_100_000) % len(vocabulary)
    texts = [" ".join(vocabulary[i] for i in at[k : k + 300]) for k in range(0, len(at), 300)]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    path = U.vocabulary(llm_queries.VOCABULARY)
    for send, most in ((hpy._send_counts, 80e6), (hpy._send_documents, 60e6)):
        run = send(llm_queries.PIECE_ORDER, 128, path)
        tracemalloc.start()
        assert sum(1 for _ in run([batch])) > 1
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most, (send.__name__, peak)


def test_strengths_are_drawn_near_the_one_that_seated(spark):
    rng, d, strength = np.random.default_rng(3), 0.3, 4.0
    c, t = [], []
    for _ in range(400):  # restaurants whose customers each bring a dish of their own table or sit down by the process
        tables = []
        for n in range(30):
            new = rng.random() < (strength + d * len(tables)) / (strength + n)
            if new:
                tables.append(1)
            else:
                w = np.array(tables) - d
                tables[rng.choice(len(tables), p=w / w.sum())] += 1
        c.append(30)
        t.append(len(tables))
    drawn, now = [], 1.0
    for _ in range(60):
        now = hpy.draw_strength(*hpy.strength_sums(np.array(c), np.array(t), d, now, rng), len(c), rng)
        drawn.append(now)
    assert np.mean(drawn[20:]) == pytest.approx(strength, rel=0.15)


def test_perplexity_separates_held_out_kinds(spark, docs, clashing, none):
    rng = random.Random(2)
    plain = lambda: " ".join(rng.choice(["sun", "moon", "star", "sky"]) for _ in range(60))
    noise = lambda: "".join(rng.choice("qwzxjkv0123456789") for _ in range(240))
    rows = [(i, plain()) for i in range(40)] + [(100 + i, noise()) for i in range(4)]
    got = {r.doc_id: r for r in hpy.pitman_yor_perplexity(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert max(got[i].perplexity for i in range(40)) < min(got[100 + i].perplexity for i in range(4))
    assert all(r.events == len(t) + 1 for i, t in rows for r in [got[i]])
    for df in (docs, clashing):
        out = hpy.pitman_yor_perplexity(df, order=3).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.events) for r in out) == sorted((r[0] is None, r[0] or 0, len(r[1] or "") + 1) for r in documents())
        assert all(np.isfinite(r.perplexity) and r.perplexity >= 1 for r in out)
    assert hpy.pitman_yor_perplexity(none).count() == 0


PAGE = "<!DOCTYPE html><html><head><title>T{0}</title><style>p{{}}</style></head><body><nav class='m'><ul><li>Home<li>About</ul></nav><p>Text {0} &amp; more<br>line<script>var x='</p>'</script></p><div><!-- c {0} -->tail {0}</div><footer>Imprint</footer></body></html>"


def test_site_templates_go_and_content_stays(spark):
    rows = [(i, f"http://A.example.com/{i}", PAGE.format(i)) for i in range(20)]
    rows += [(100 + i, f"https://b.example.org:8080/{i}", PAGE.format(i)) for i in range(2)]
    rows += [(200, None, None), (201, "nonsense", ""), (202, "http://a.example.com/x", "plain > text < here"), (None, "http://c.example.net", "<p>a<p>b<div>" * 3000), (204, "http://c.example.net", "<b" * 50)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "2 AS template", "3 AS hash", "4 AS text")
    got = {r.page_id: r for r in sites.site_text(df).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "Text 3 & more\nline\ntail 3" and got[3].removed == 2 and got[3].host == "a.example.com"
    assert got[100].text == "Home\nAbout\nText 0 & more\nline\ntail 0\nImprint" and got[100].removed == 0
    assert got[200].text == "" and got[201].text == "" and got[202].text == "plain > text < here"
    assert got[None].text.count("a") == 3000
    assert sites.site_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_template_counts_against_brute_force(spark):
    rng = random.Random(8)
    blocks = [f"<div><p>block {k}</p></div>" for k in range(8)]
    rows = [(i, f"http://h{i % 3}.com/", "<body>" + "".join(rng.sample(blocks, 3)) + f"<p>own {i}</p></body>") for i in range(90)]
    seen, pages = collections.Counter(), collections.Counter()
    for _, url, html in rows:
        pages[url] += 1
        for k, b in enumerate(blocks):
            seen[url, k] += b in html
    got = {r.page_id: r.text for r in sites.site_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"), 12, 0.3).collect()}
    for i, url, html in rows:
        kept = [(html.index(b), f"block {k}") for k, b in enumerate(blocks) if b in html and not (seen[url, k] >= 12 and seen[url, k] >= 0.3 * pages[url])]
        assert got[i] == "\n".join([x for _, x in sorted(kept)] + [f"own {i}"])


def test_templates_are_decided_alike_on_every_size_of_host(spark):
    nav = "<nav><ul><li>Home {0}<li>About {0}</ul></nav>"
    rows = [(i, "http://big.com/", f"<body>{nav.format(i // 6)}<p>own {i}</p>{'<footer>rare</footer>' if i < 4 else ''}</body>") for i in range(600)]
    rows += [(1000 + i, "http://small.com/", f"<body>{nav.format(0)}<p>own {i}</p></body>") for i in range(6)]
    got = {r.page_id: (r.text, r.removed) for r in sites.site_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: (f"own {i % 1000}" + ("\nrare" if i < 4 else ""), 1) for i, *_ in rows}


def test_reputation_shrinks_and_handles_odd_rows(spark):
    pages = [(i, f"http://good.a.com/{i}") for i in range(20)] + [(100 + i, f"http://bad.a.com/{i}") for i in range(20)]
    pages += [(200, "http://new.a.com/"), (201, "http://x.co.uk/"), (202, None), (203, "no url"), (204, "HTTP://User@Good.A.com:80/?q")]
    labels = [(i, 1, 0) for i in range(20)] + [(100 + i, 0, 0) for i in range(20)] + [(0, None, 0), (999, 1, 0), (None, 1, 0)]
    p = spark.createDataFrame(pages, "page_id bigint, url string").selectExpr("*", "1 AS n", "2 AS s", "3 AS good")
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "5 AS host")
    got = {r.page_id: r for r in host_reputation(p, lab).collect()}
    assert len(got) == len(pages)
    assert got[0].keep and not got[100].keep and got[0].mean < 1 and got[100].mean > 0
    assert got[100].mean < got[200].mean < got[0].mean and got[200].labelled == 0
    assert got[201].suffix == "co.uk" and got[201].domain == "x.co.uk"
    assert got[202].lower is None and not got[202].keep and not got[203].keep
    assert got[204].host == "good.a.com" and got[204].mean == got[0].mean
    empty = lab.where("false")
    assert {r.mean for r in host_reputation(p, empty).collect()} == {0.5, None}
    assert host_reputation(p.where("false"), lab).count() == 0
