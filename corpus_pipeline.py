"""The corpus pipeline: quality rules, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm.best_fit_packing import best_fit_packing
from textmill.llm.exchange import cut
from textmill.llm.fertility import keep_fertile
from textmill.llm.ngram_jaccard_join import drop_near_copies
from textmill.llm.suffix_array_dedup import drop_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the tokeniser-fertility bands of their language."""
    return keep_fertile(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of n-gram Jaccard neighbours."""
    return drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins."""
    return best_fit_packing(docs)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", near_copies), ("suffix_array_dedup", repeated_passages), ("best_fit_packing", packing)]

#: Tokenisation and branch and bound have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
