"""The pipeline as a whole, stage by stage."""

import corpus_pipeline
from textmill.llm import fertility
from textmill.llm import suffix_array_dedup as suffixes

from .test_operators import SCHEMA, WORD, documents


def test_stages_keep_the_columns_and_clean_documents(spark, tmp_path):
    docs = spark.createDataFrame(documents(), SCHEMA)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "best_fit_packing"]
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 3:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.collect())
    rows = {r[0]: r[1] for r in documents() if r[0] is not None}
    accepted = {r.doc_id for r in fertility.tokenizer_fertility(spark.createDataFrame(documents(), SCHEMA)).where("accepted").collect()}
    assert {r.doc_id for r in seen[0]} == accepted and set(range(31)) <= accepted
    kept = {r.doc_id for r in seen[1]}
    assert accepted - kept == {26, 27, 30}
    assert {r.doc_id for r in seen[2]} == kept
    texts = {r.doc_id: r.text for r in seen[2]}
    assert all(texts[i] == rows[i] for i in range(26))
    assert all(r.n_chars == len(r.text) for r in seen[2])
    assert len(WORD.findall(texts[29])) == len(WORD.findall(rows[29])) - 60
    again = suffixes.suffix_array_dedup(spark.createDataFrame([tuple(r) for r in seen[2]], SCHEMA)).where("NOT kept")
    assert again.count() == 0
    packed = {}
    for r in seen[3]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_chars
    size = {}
    for r in seen[2]:
        if r.text:
            size[r.doc_id] = size.get(r.doc_id, 0) + len(r.text)
    assert packed == size


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == ["bin_id", "place", "doc_id", "piece", "start_char", "n_chars", "bin_chars"]
