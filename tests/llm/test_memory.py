"""What Python workers hold beside an executor's heap, within a chunk and between steps."""

import os
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from textmill.llm import fertility
from textmill.llm import units as U
from textmill.llm import words as W

from ..conftest import ROOT
from .test_operators import SCHEMA, documents

BETWEEN_STEPS = """
import re, sys
import pyarrow as pa
from pyspark.sql import SparkSession
import corpus_pipeline

spark = SparkSession.builder.master("local[1]").config("spark.sql.shuffle.partitions", "1").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")

def held(batches):
    for _ in batches:
        yield pa.record_batch([pa.array([sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024])], ["mb"])

def now():
    return spark.range(0, 1, 1, 1).mapInArrow(held, "mb double").first().mb

docs = spark.createDataFrame([(i, " ".join(f"the {(i * 7919 + k * k) % 50021} of house{(i * i + k) % 977} and" for k in range(700)), "en", "web", 0) for i in range(600)], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(1)
docs.write.parquet(sys.argv[1] + "/in")
docs, before = spark.read.parquet(sys.argv[1] + "/in"), now()
for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
    stage(spark, docs, "").write.parquet(f"{sys.argv[1]}/{k}")
    print("HELD", name, now() - before)
"""


def test_sums_and_hashes_do_not_depend_on_blocks():
    rng, m = np.random.default_rng(5), 1 << 64
    for n in (0, 1, W._BLOCK, 2 * W._BLOCK + 3):
        x, total, power, want = rng.integers(0, m, n, np.uint64), 0, 1, [0]
        for v in x.tolist():
            total, power = (total + (v + 1) * power) % m, power * W._R % m
            want.append(total)
        assert W.power_sums(x, 1).tolist() == want
        place = np.arange(n)[::-1]
        y = W.unpowered(x.copy(), place)
        assert all(v * pow(W._R, p, m) % m == u for v, p, u in list(zip(y.tolist(), place.tolist(), x.tolist()))[:: max(1, n // 50)])
    # The same words and units far apart have the same hashes.
    text = pa.array(["house of the house", "x " * W._BLOCK + "house of the house"])
    h, _, _, woff = W.words(text)
    assert h[:4].tolist() == h[-4:].tolist() and woff[1] == 4
    raw, _, start, end = U.piece_units(text)
    units = U.hashes(raw, start, end)
    assert units[0] == units[3] == units[-1] == units[-4] and len(set(units.tolist())) == 4


def test_hashing_a_chunk_takes_a_few_times_its_sums():
    text = pa.array(["abcd efgh ijk " * 220_000])
    W.words(pa.array(["x"]))
    for of in (lambda: W.words(text, False), lambda: U.hashes(*(x for i, x in enumerate(U.piece_units(text)) if i != 1))):
        tracemalloc.start()
        try:
            of()
            _, peak = tracemalloc.get_traced_memory()
        finally:
            tracemalloc.stop()
        # Sums take 8 bytes a byte; before, powers, terms and sums took 40 and more.
        assert peak < 30 * 14 * 220_000
    assert sum(x.nbytes for x in W._POW.values()) < 4_000_000


def test_workers_give_back_what_the_steps_of_the_pipeline_freed(tmp_path):
    env = os.environ | {"PYTHONPATH": os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])}
    ran = subprocess.run([sys.executable, "-c", BETWEEN_STEPS, str(tmp_path)], env=env, cwd=ROOT, capture_output=True, text=True, timeout=300)
    held = {x.split()[1]: float(x.split()[2]) for x in ran.stdout.splitlines() if x.startswith("HELD")}
    assert len(held) == 3, ran.stderr[-2000:]
    assert max(held.values()) < 100, held


def test_fertile_documents_whatever_the_name_place_and_type_of_the_text(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    want = sorted(map(str, fertility.keep_fertile(docs).select("doc_id", "text").collect()))
    other = docs.selectExpr("named_struct('text', 1) AS __text", "text AS TEXT", "doc_id", "lang")
    got = fertility.keep_fertile(other)
    assert got.dtypes == other.dtypes
    assert sorted(map(str, got.selectExpr("doc_id", "TEXT AS text").collect())) == want
    binary = docs.selectExpr("doc_id", "CAST(text AS binary) AS text", "lang")
    got = fertility.keep_fertile(binary)
    assert got.dtypes == binary.dtypes
    assert sorted(map(str, got.selectExpr("doc_id", "CAST(text AS string) AS text").collect())) == want
