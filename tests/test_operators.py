"""Operators that have no SQL form, sources, sinks and streams."""

import gzip
import json

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textmill import config
from textmill.functions import lineage, urls
from textmill.functions import text as T
from textmill.operators import cleaning, crawl, dedup, html, metadata, mixing, neardup, pii, quality
from textmill.sources import readers, writers
from textmill.streaming import stream


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first().x


def test_personal_data_is_found_and_redacted(spark):
    text = "mail a.b@c.example.org, see @someone at 192.168.30.40 or :: on 12.05.2020; key ab12cd34ef56gh78 and a.b@c.example.org"
    rows = pii.run_pii(spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "doc_id int, text string")).collect()
    found = [(m["tag"], m["match"]) for m in json.loads(rows[0].regex_metadata)]
    assert ("EMAIL", "a.b@c.example.org") in found and ("USER", "@someone") in found and ("IP_ADDRESS", "192.168.30.40") in found
    assert "a.b@c" not in rows[0].text and "PI:EMAIL" in rows[0].text and rows[0].modified
    assert rows[1].text == "nothing" and not rows[1].modified and rows[2].text is None


def test_html_text_and_errors(spark):
    page = "<html lang='fr'><head><title>T</title></head><body><header>h</header><p>short</p><p>" + "long " * 20 + "<br>x</p><script>s</script><form>f</form></body></html>"
    rows = html.with_text(spark.createDataFrame([(1, page), (2, None), (3, "<<<")], "page_id int, html string")).orderBy("page_id").collect()
    assert rows[0].html_title == ["T"] and "long" in rows[0].text and "short" not in rows[0].text and "\nx" in rows[0].text
    assert all(w not in rows[0].text for w in ("h\n", "script", "f\n")) and rows[1].text == ""
    with pytest.raises(ValueError):
        html.with_text(spark.createDataFrame([("a", "b")], "html string, text string"))
    bad = html.guarded(lambda x: 1 / 0)("x")
    assert bad["html_error"] == 1 and "ZeroDivision" in bad["html_comment"]


def brute_repetition(text, n):
    from collections import Counter

    c = Counter(text[i : i + n] for i in range(len(text) - n + 1))
    if not c:
        return 0.0
    f = sorted(c.values(), reverse=True)
    return sum(f[: min(int(len(f) ** 0.5), len(f) - f.count(1))]) / sum(f)


@pytest.mark.parametrize("text", ["", "abc", "abcabcabcabc", "aaaaaaaaaaaaaaa", "é中é中é中😀é中"])
def test_repetition(text):
    for n in (1, 2, 5):
        assert quality.char_repetition(text, n) == pytest.approx(brute_repetition(text, n))
    assert quality.word_repetition("a b a b a c".split(), 2) == pytest.approx(4 / 5)
    assert quality.word_repetition([], 2) == 0.0


def brute_word_repetition(words, n):
    from collections import Counter

    c = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return sum(v for v in c.values() if v > 1) / c.total() if c else 0.0


def test_repetition_of_many_texts_at_once(spark):
    """Texts in one chunk keep their own n-grams, and the maps have every n; no n is hashed from the start."""
    texts = ["", "a", "ab " * 40, "é中é中é中😀é中" * 9, "The the a B. a b a b a b " * 7, None, "no word twice here", "x" * 70_000, "ab " * 40, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 " * 3]
    got = quality.repetition_maps(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        t = t or ""
        assert r.char_repetition == {n: round(brute_repetition(t, n), 4) for n in range(2, 16)}
        assert r.word_repetition == {n: round(brute_word_repetition(quality.words_of(t), n), 4) for n in range(3, 11)}
    ks = ["zh", "en", "ur", None, "en", "en", "zh", "en", "xx", "ur"]
    rows = quality.with_metrics(spark.createDataFrame(list(zip(range(10), texts, ks)), "doc_id int, text string, lang string").coalesce(1)).orderBy("doc_id").collect()
    for t, k, r in zip(texts, ks, rows):
        want = None if t is None else (brute_repetition(t, 3 if k == "zh" else 10), brute_word_repetition(quality.words_of(t), 7 if k == "ur" else 5))
        assert (r.char_repetition, r.word_repetition) == (want or (None, None))
    assert [c.start for c in quality.chunks([5, 5, 90, 5, 5], 10)] == [0, 2, 3]


def test_words_are_stripped_once_and_not_kept_for_ever(monkeypatch):
    monkeypatch.setattr(quality, "_MOST_STRIPPED", 3)
    quality._stripped.clear()
    assert quality.words_of("(A) b\t(A)\n-- c.") == ["a", "b", "a", "c"] and len(quality._stripped) == 4
    kept = quality.words_of("(A) (a)")
    assert kept[0] is kept[1] and len(quality._stripped) == 1


def test_a_step_serves_all_lengths_of_runs(monkeypatch):
    """The maps need one step from n to n + 1 and not n steps for each n."""
    steps, one = [], quality._joined
    monkeypatch.setattr(quality, "_joined", lambda a, b: steps.append(1) or one(a, b))
    quality._all_n(quality._char_shares, quality.char_codes(["abcabc" * 9]), [54], quality.MAPS_CHAR)
    assert len(steps) == 14
    steps.clear()
    quality.char_repetition("abcabc" * 9, 10)
    assert len(steps) == 4


def test_simhash_search_is_exact(spark):
    import random

    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    hashes = base + [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base[:10]] + [base[0] ^ 0b1111]
    hashes = [h - (1 << 64) if h >> 63 else h for h in hashes]
    got = {(r.a, r.b): r.diff for r in neardup.near_pairs(spark.createDataFrame([(h,) for h in hashes + [None]], "hash bigint"), 6, 3).collect()}
    want = {(a, b): bin((a ^ b) & (2**64 - 1)).count("1") for a in set(hashes) for b in set(hashes) if a < b}
    assert got == {k: v for k, v in want.items() if v <= 3}


def test_keys_of_hashes_are_not_broadcast(spark):
    """Each hash has a row for each choice of blocks, which no driver should have to hold."""
    pairs = neardup.near_pairs(spark.range(300).select(F.xxhash64("id").alias("hash")))
    pairs.collect()
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_representatives(spark):
    docs = spark.createDataFrame([(4, 7), (2, 7), (9, 5), (1, None), (3, 5), (None, 5)], "doc_id bigint, hash bigint")
    pairs = neardup.near_pairs(docs)
    got = neardup.representative_pairs(docs, pairs).collect()
    assert [tuple(r) for r in got] == [(2, 3, 1, 2, 3)]
    each = {(r.id1, r.id2) for r in neardup.id_pairs(docs, pairs).collect()}
    assert each == {(2, 3), (3, 4), (2, 9), (4, 9)}


def test_simhash_quirks():
    assert neardup.simhash("", 4) == 0 == neardup.simhash("abcd", 4) and neardup.simhash("abcde", 4) != 0
    a, b = neardup.simhash("the quick brown fox jumps over it " * 5), neardup.simhash("the quick brown fox jumped over it " * 5)
    assert bin((a ^ b) & (2**64 - 1)).count("1") < 24


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (20, 21)]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 12: 10, 20: 20, 21: 20}


def test_clusters_of_equal_hashes(spark):
    docs = spark.createDataFrame([(5, 1), (3, 1), (8, 3), (2, 64), (6, 64), (1, None), (4, None), (7, 200)], "doc_id bigint, hash bigint")
    pairs = spark.createDataFrame([(1, 3)], "a bigint, b bigint")
    of = lambda x: {r.doc_id: r.cluster for r in neardup.clusters(docs, pairs, x).collect()}
    apart = {1: -1, 4: -1, 7: -1}
    assert of(False) == {5: 3, 3: 3, 8: 3, 2: -1, 6: -1, **apart}
    assert of(True) == {5: 3, 3: 3, 8: 3, 2: 2, 6: 2, **apart}


def test_registry_runs_names_in_order(spark):
    df = spark.createDataFrame([(1, "a\nb " + "w " * 20), (2, "  "), (3, "a{b}\nkeep " + "x " * 20), (4, "a{b}\nkeep " + "x " * 20)], "doc_id bigint, text string")
    out = cleaning.run(df, ["remove_lines_with_code", "filter_remove_empty_docs", "dedup_document", "filter_small_docs"])
    assert {r.doc_id for r in out.collect()} == {1, 3}
    assert cleaning.apply("KILL", df).count() == 0
    with pytest.raises(KeyError):
        cleaning.apply("no such", df)


def test_texts_of_all_kinds(spark):
    assert one(spark, T.unicode_strip(F.col("text")), "　 a  ") == "a"
    assert one(spark, T.normalize(F.col("text")), " Ab １２…\x07") == "ab 00..."
    assert one(spark, T.special_ratio(F.col("text")), "") == 0.0
    assert one(spark, dedup.first_lines_within(F.col("text")), "a\n\nb\na\n\nb") == "a\n\nb\n"
    assert one(spark, cleaning.split_sentences(F.col("text")), "One. Two! 3.5 is") == "One.\nTwo!\n3.5 is"


def test_water_levels():
    levels = mixing.water_level_steps([5, 100, 40], 60)
    assert levels[0] == 5 and 60 <= sum(levels) <= 63 and max(levels) <= 40


def test_ratios_are_checked(spark):
    assert mixing.check_ratios(spark.createDataFrame([(0.5,)], "ratio double")).count() == 1
    with pytest.raises(Exception):
        mixing.check_ratios(spark.createDataFrame([(1.5,)], "ratio double")).collect()


def test_writers_and_readers(spark, tmp_path):
    df = spark.range(20).selectExpr("id", "concat('text ', id) AS text", "id % 3 AS seed_id")
    writers.json_lines(df, f"{tmp_path}/json", shards=4, gzip=True)
    assert readers.json_lines(spark, f"{tmp_path}/json", "id bigint, text string, seed_id bigint", recursive=True, pattern="*.json.gz").count() == 20
    assert writers.contiguous_shards(df, f"{tmp_path}/ranges", "id", 50) == 3
    writers.partitioned(df, f"{tmp_path}/seeds", "seed_id")
    assert readers.seed_shard(spark, f"{tmp_path}/seeds", 1).count() == 7
    writers.csv(df.select("id"), f"{tmp_path}/csv")
    assert readers.csv_table(spark, f"{tmp_path}/csv", "id bigint").count() == 20
    writers.save(df, f"{tmp_path}/once")
    with pytest.raises(Exception):
        writers.save(df, f"{tmp_path}/once")
    (tmp_path / "names.txt").write_text("a\n\nb\n")
    (tmp_path / "values.txt").write_text('{"n": 1}\nbroken\n')
    rows = readers.paired_lines(spark, f"{tmp_path}/names.txt", f"{tmp_path}/values.txt", "n int").orderBy("name").collect()
    assert [(r.name, r.bad) for r in rows] == [("a", False), ("b", True)] and rows[0].value.n == 1


def test_records_are_fetched_row_by_row(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>\xe9</p>"
    record = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\n" + body)
    (tmp_path / "w.gz").write_bytes(b"xx" + record)
    df = spark.createDataFrame([(1, f"{tmp_path}/w.gz", 2, len(record)), (2, f"{tmp_path}/none", 0, 1)], "id int, warc_filename string, warc_record_offset int, warc_record_length int")
    got = {r.id: r for r in readers.fetch_records(df).collect()}
    assert readers.html_of(bytes(got[1].compressed_warc), "text/html") == ("<p>é</p>", None)
    assert got[2].compressed_warc is None and "FileNotFound" in got[2].download_exception
    assert readers.failed(readers.fetch_records(df)).count() == 1
    assert readers.html_of(b"junk", "text/html")[1] and readers.html_of(record, "text/plain") == (None, None)


def test_streams(spark, tmp_path):
    docs = pd.DataFrame({"doc_id": [1, 2, 3], "text": ["w " * 20, "w " * 20, "short"]})
    spark.createDataFrame(docs).write.parquet(f"{tmp_path}/in")
    source = stream.documents(spark, f"{tmp_path}/in", "doc_id bigint, text string")
    stream.write(stream.first_texts(stream.clean(source)), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_model_scores_are_per_worker(spark):
    score = quality.model_score(lambda: lambda texts: [float(len(t)) for t in texts], F.col("text"))
    rows = spark.createDataFrame([("abc",), (None,), ("",)], "text string").select(score.alias("s")).collect()
    assert [r.s for r in rows][0] == 3.0 and rows[1].s is None or rows[1].s != rows[1].s


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_ids_of_a_wide_table(spark, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        n = 2_000_000
        df = spark.range(n).selectExpr("(id * 7919) % 1000003 AS k", "repeat(cast(id AS string), 3) AS a", "id AS b", "md5(cast(id AS string)) AS c").repartition(6)
        out = crawl.dense_ids(df, "k")
        got = out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_distinct("b").alias("b")).first()
        assert (got.n, got.d, got.lo, got.hi, got.b) == (n, n, 0, n - 1, n)
        wrong = out.selectExpr("k", "lead(k) OVER (PARTITION BY id DIV 1000 ORDER BY id) AS next").where("next < k").count()
        assert wrong == 0 and out.columns == ["k", "a", "b", "c", "id"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_dense_ids_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, "x"), (3, "y"), (None, "x"), (1, "z")], "k int, __at string")
    assert [(r.id, r.k) for r in crawl.dense_ids(df, "k").orderBy("id").collect()] == [(0, None), (1, None), (2, 1), (3, 3)]
    assert crawl.dense_ids(df.limit(0), "k").count() == 0


def test_copies_with_odd_ids(spark):
    rows = [(1, "a"), (1, "b"), (None, "zz"), (5, "q"), (5, "q"), (None, "b"), (7, None), (8, None), (None, "zz")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    blank = sorted((r.doc_id or 0, r.text or "") for r in dedup.blank_copies(df, F.col("text")).collect())
    assert blank == sorted([(1, "a"), (1, "b"), (0, "zz"), (5, "q"), (5, ""), (0, ""), (7, ""), (8, ""), (0, "")])
    kept = sorted((r.doc_id or 0, r.text or "") for r in dedup.drop_copies(df, F.col("text")).collect())
    assert kept == sorted([(1, "a"), (1, "b"), (0, "zz"), (5, "q"), (7, "")])
    assert dedup.duplicates(df, F.col("text")).count() == 8
    assert dedup.drop_copies(df.limit(0), F.col("text")).count() == 0


def test_lines_of_odd_rows(spark):
    rows = [(1, "x\n\nlong template line\ny"), (None, "long template line\nx"), (2, None), (2, ""), (1, "x\n\nlong template line\ny")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    out = dedup.drop_template_lines(df, 5, 3)
    assert sorted(r.text for r in out.collect()) == ["", "", "x", "x\n\ny", "x\n\ny"]
    first = {(r.doc_id, r.text) for r in dedup.first_of_lines(df).collect()}
    assert first == {(1, "x\nlong template line\ny"), (None, ""), (2, "")}


def test_public_suffixes(spark):
    hosts = {"a.b.co.uk": "b.co.uk", "co.uk": "co.uk", "x.y.example.com": "example.com", "me.github.io": "me.github.io", "a.me.github.io": "me.github.io", "x.city.kawasaki.jp": "city.kawasaki.jp", "a.b.foo.kawasaki.jp": "b.foo.kawasaki.jp", "www.ck": "www.ck", "a.b.ck": "a.b.ck", "192.168.0.1": "192.168.0.1", "localhost": "localhost"}
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", urls.domain_of(F.col("h")).alias("d"), urls.public_suffix(F.col("h")).alias("s"))
    got = {r.h: (r.d, r.s) for r in df.collect()}
    assert {h: d for h, (d, _) in got.items()} == hosts
    assert got["a.b.co.uk"][1] == "co.uk" and got["a.b.ck"][1] == "b.ck" and got["192.168.0.1"][1] == "192.168.0.1"
    assert one(spark, F.to_json(urls.parameters(F.col("text"))), "http://a/?q=a%20b&x=&y&z=1+2#f") == '[{"name":"q","value":"a b"},{"name":"z","value":"1 2"}]'


def test_metrics_equal_the_columns(spark):
    texts = ["", "The cat, the hat\nand THE\tmat! $$$", "İstanbul ΟΔΟΣ ß", None, "a" * 50_000, "  \n ", "不了 有 和"]
    df = spark.createDataFrame([(t, "zh" if t and "不" in t else "en") for t in texts], "text string, lang string")
    rows = quality.with_metrics(df).withColumn("words", T.words(F.col("text"))).withColumn("special", T.special_ratio(F.col("text"))).collect()
    for r in rows:
        if r.text is None:
            assert r.n_words is None and r.special_ratio is None and r.word_repetition is None
            continue
        assert r.n_words == len(r.words) and r.special_ratio == pytest.approx(r.special)
    assert rows[1].stopword_ratio == pytest.approx(4 / 7) and rows[0].stopword_ratio == 0.0
    assert quality.filter_documents(df.limit(0)).count() == 0
    assert quality.words_of("a\tb c") == ["a", "b", "c"]


def test_repair_by_language(spark):
    text = "see http://x.org/a now\n\n" + "w" * 60 + " end\tcell www\t"
    df = spark.createDataFrame([(text, k) for k in ("en", "de", "zh", None)], "text string, lang string")
    got = [r.x for r in df.select(quality.repair(F.col("text")).alias("x")).collect()]
    assert got[0] == "see now\nend\tcell"
    assert got[1] == got[2] == got[3] == "see http://x.org/a now\n" + "w" * 60 + " end\tcell www"


def test_tokenization_and_language_plug_ins(spark):
    df = spark.createDataFrame([("ab c",), (None,)], "text string")
    assert [r.x for r in df.select(quality.tokenization(F.col("text"), lambda: list, join=True).alias("x")).collect()] == ["a b   c", None]
    info = quality.language_info(F.col("text"), lambda: lambda texts: [("xx", float(len(t))) for t in texts])
    rows = spark.createDataFrame([("ab\nc",), (None,)], "text string").select(info.alias("i")).collect()
    assert rows[0].i.lang == "xx" and [x.score for x in rows[0].i.lines] == [2.0, 1.0]
    assert [r.x for r in spark.createDataFrame([("the the der",)], "text string").select(quality.vote_language(F.col("text"))["lang"].alias("x")).collect()] == ["en"]


def test_votes_hold_few_texts_at_a_time(spark, monkeypatch):
    """A batch stays in Arrow; only a slice of it is Python strings."""
    import pyarrow as pa

    texts, seen = ["the the der", None, "", "und der die", "the of"] * 3, []
    votes = quality.vote_language(F.col("text"))
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).select(votes.alias("v")).select("v.*").collect()
    assert [tuple(r) for r in rows] == [("en", 2 / 3), (None, None), ("unknown", 0.0), ("de", 1.0), ("en", 1.0)] * 3
    monkeypatch.setattr(quality, "ROWS", 2)
    make, one = F.arrow_udf, []
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: one.append(f) or make(kind)(f))
    quality.vote_language(F.col("text"))

    class Batch:
        def __len__(self):
            return len(texts)

        def slice(self, at, n):
            seen.append(n)
            return pa.array(texts, pa.string()).slice(at, n)

    assert next(one[0](iter([Batch()]))).to_pylist()[:2] == [{"lang": "en", "score": 2 / 3}, {"lang": None, "score": None}]
    assert seen == [2] * 8


def test_references_need_stop_words(spark):
    with pytest.raises(KeyError):
        cleaning.remove_references(F.col("text"), "xx")
    assert one(spark, cleaning.remove_references(F.col("text"), "pt"), "o gato e a casa\nSilva 2004\n") == "o gato e a casa"
    assert one(spark, cleaning.remove_references(F.col("text"), "zh"), "这是我们的一个\nSmith 2003") == "这是我们的一个"


def test_the_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Far:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError):
        lineage.shared_folder(Far)
    table = lineage.written(spark.range(3))
    assert table.count() == 3
    lineage.release(table)


def test_personal_data_has_its_places(spark):
    text = "a.b@c.example.org wrote @me to a.b@c.example.org (x)"
    row = pii.run_pii(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")).orderBy("doc_id").first()
    places = json.loads(row.regex_metadata)
    assert [text[m["start"] : m["end"]] for m in places] == [m["match"] for m in places]
    assert sorted(m["start"] for m in places if m["tag"] == "EMAIL") == [0, 31]
    assert pii.only_modified(pii.run_pii(spark.createDataFrame([(1, text), (2, "plain")], "doc_id int, text string"))).count() == 1


def test_metadata_of_all_kinds(spark):
    metas = ['{"a": 1, "b": null}', "{'a': None, 'b': ['x', 1]}", "not a dict", None, "__import__('os').getcwd()", "[1]"]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(metas)], "id int, meta string").select("id", metadata.parse_meta(F.col("meta")).alias("m")).orderBy("id")
    got = [r.m for r in df.collect()]
    assert got == [{"a": "1", "b": None}, {"a": None, "b": '["x", 1]'}, None, None, None, None]
    docs = spark.createDataFrame([("t", None, 5)], "text string, meta string, n int")
    out = metadata.folded(docs, F.lit("src"), default={"k": "v"}).first()
    assert json.loads(out.meta) == {"k": "v", "n": "5", "source_dataset": "src"} and out.text == "t"
    assert metadata.processes(-1, 8) == 8
    with pytest.raises(ValueError):
        metadata.processes(9, 8)


def test_plug_ins_add_columns(spark):
    class Length(metadata.Preprocessor):
        columns = "n int"

        def preprocess(self, batch):
            return batch.assign(n=batch["text"].str.len())

    assert [r.n for r in metadata.preprocessed(spark.createDataFrame([("ab",), ("",)], "text string"), Length()).collect()] == [2, 0]


def test_shards_and_lists_keep_the_order(spark, tmp_path):
    df = spark.range(20).selectExpr("19 - id AS id", "concat('t', id) AS text").repartition(3)
    writers.round_robin_shards(df, f"{tmp_path}/rr", "id", 8)
    rows = spark.read.json(f"{tmp_path}/rr").collect()
    assert {(r.id % 8, r.shard) for r in rows} == {(k, f"0{k}-of-08") for k in range(8)} and len(rows) == 20
    writers.aligned_columns(df, f"{tmp_path}/two", "id", "text")
    ids = [r.value for r in spark.read.text(f"{tmp_path}/two/id.csv").select("value").collect()]
    assert sorted(map(int, ids)) == list(range(20))
    for k, body in enumerate(("n\nb\na\n", "n\nz\n")):
        (tmp_path / f"l{k}.csv").write_text(body)
    got = readers.listed(spark, [f"{tmp_path}/l1.csv", f"{tmp_path}/l0.csv"], "n string", "n").orderBy("row").collect()
    assert [(r.row, r.value) for r in got] == [(0, "z"), (1, "b"), (2, "a")]
    assert [r.id for r in readers.row_range(df, "id", 5, 8).orderBy("id").collect()] == [5, 6, 7]
    with pytest.raises(Exception):
        readers.one_seed(df.selectExpr("id AS seed_id"), 3).collect()


def test_pages_of_records(spark):
    def record(body, kind="text/html"):
        return gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: " + kind.encode() + b"\r\n\r\n" + body)

    rows = [(1, record("<meta charset=cp1251><p>да".encode("cp1251")), "text/html"), (2, record(b"caf\xe9"), "text/html"), (3, record("é".encode()), "text/html"), (4, None, "text/html"), (5, b"junk", "text/html")]
    df = readers.with_html(spark.createDataFrame(rows, "id int, compressed_warc binary, content_mime_detected string")).orderBy("id").collect()
    assert df[0].html_str.endswith("да") and df[1].html_str == "café" and df[2].html_str == "é" and df[3].html_str is None and df[4].html_error


def test_job_settings(tmp_path):
    (tmp_path / "job.yaml").write_text("# near copies\ninput: /a\noutput: '/b'\nwindow_size: 4  # words\nlowercase: no\n")
    job = config.load(str(tmp_path / "job.yaml"))
    assert (job.input, job.output, job.window_size, job.lowercase, job.num_blocks) == ("/a", "/b", 4, False, 5)
    (tmp_path / "bad.yaml").write_text("input: a\noutput: b\nwindows: 3\n")
    with pytest.raises(ValueError):
        config.load(str(tmp_path / "bad.yaml"))


@pytest.mark.parametrize("hot", [0, 2, 1000])
def test_links_to_hot_urls_meet_no_shuffled_join(spark, hot):
    """Known and unknown URLs with many links are looked up by broadcast, with the same ids in the same order."""
    rows = [(i, f"u{i % 4}", i // 4, ["nowhere", "u1", None, f"u{i % 5}"]) for i in range(12)] + [(12, None, 1, None), (13, "u3", 0, [])]
    pages = spark.createDataFrame(rows, "id int, url string, fetch_time int, external_urls array<string>")
    newest = {"u0": 8, "u1": 9, "u2": 10, "u3": 11}
    got = {r.id: r.external_ids for r in crawl.external_ids(pages, hot=hot).collect()}
    assert got == {i: [newest[u] for u in us or [] if u in newest] for i, _, _, us in rows}


def test_no_task_gets_all_links_to_one_url(spark):
    """Where the planner broadcasts nothing of itself, a URL of 60,000 links still is."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = spark.range(60_000).select("id", F.col("id").cast("string").alias("url"), F.lit(0).alias("fetch_time"), F.array(F.lit("nowhere"), F.lit("7")).alias("external_urls"))
        out = crawl.external_ids(pages)
        assert {tuple(r.external_ids) for r in out.collect()} == {(7,)}
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_crawl_expansion_by_depth(spark):
    index = spark.createDataFrame([("a", ["b", "c"]), ("b", ["d", "a"]), ("c", []), ("d", ["e"]), ("e", [])], "url string, external_urls array<string>")
    got = {r.url: r.depth for r in crawl.expand(index.where("url = 'a'"), index, 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_streams_count_by_window_and_forget(spark, tmp_path):
    rows = pd.DataFrame({"doc_id": [1, 2, 3], "text": ["x", "x", "y"], "lang": ["en", "en", "fr"], "ts": pd.to_datetime(["2024-01-01 00:10", "2024-01-01 00:20", "2024-01-01 05:00"])})
    spark.createDataFrame(rows).write.parquet(f"{tmp_path}/in")
    source = stream.documents(spark, f"{tmp_path}/in", "doc_id bigint, text string, lang string, ts timestamp")
    stream.write(stream.first_texts(source, "ts"), f"{tmp_path}/out", f"{tmp_path}/s1").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    stream.write(stream.counts(source, "ts", "lang"), f"{tmp_path}/n", f"{tmp_path}/s2").awaitTermination(120)
    assert {(r.lang, r.n) for r in spark.read.parquet(f"{tmp_path}/n").collect()} == {("en", 2)}
    stream.write_shuffled(source, f"{tmp_path}/sh", f"{tmp_path}/s3", 2).awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/sh").count() == 2


def test_deviation_of_token_lengths_as_sql_has_it(spark):
    """Tokens whose deviation is 3 in exact arithmetic: taken up one by one it is above by a last digit, as in SQL; by a difference of sums it is not."""
    text = " ".join("x" * n for n in (8, 12, 8, 5, 11, 6, 2, 7, 6, 5, 4, 1, 3, 6))
    want = duckdb.execute("SELECT list_stddev_pop(list_transform(string_split(?, ' '), lambda x: length(x)::DOUBLE))", [text]).fetchone()[0]
    std = [r.x for r in spark.createDataFrame([(1, text), (2, "one"), (3, ""), (4, None)], "id int, text string").select("id", cleaning.token_length_std(F.col("text")).alias("x")).orderBy("id").collect()]
    assert std == [want, 0.0, 0.0, 0.0] and want > 3
