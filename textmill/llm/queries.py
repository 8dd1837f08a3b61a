"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .best_fit_packing import best_fit_packing
from .fertility import tokenizer_fertility
from .gumbel_segmentation import gumbel_segmentations
from .host_reputation import ORACLE as HOST_REPUTATION_SQL
from .host_reputation import host_reputation
from .ngram_jaccard_join import ngram_jaccard_join
from .pitman_yor import PIECE_ORDER, VOCABULARY, pitman_yor_perplexity
from .site_templates import site_text
from .suffix_array_dedup import suffix_array_dedup
from .token_counts import token_counts
from .vp_tree_search import EVERY, vp_tree_search


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_tree_search(_read(spark, sf_dir, "embeddings"), every=EVERY)


def op2_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_fertility(_read(spark, sf_dir, "documents"))


def op3_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gumbel_segmentations(_read(spark, sf_dir, "documents"))


def op4_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_text(_read(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(_read(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_read(spark, sf_dir, "documents"))


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


def op8_pitman_yor_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor_perplexity(_read(spark, sf_dir, "documents"), PIECE_ORDER, vocabulary=VOCABULARY)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(_read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_vp_tree_search,
        op2_tokenizer_fertility,
        op3_gumbel_segmentations,
        op4_site_templates,
        op5_best_fit_packing,
        op6_ngram_jaccard_join,
        op7_host_reputation,
        op8_pitman_yor_perplexity,
        op9_token_counts,
        op10_suffix_array_dedup,
    )
}
ORACLE_SQL: dict[str, str] = {"op7_host_reputation": HOST_REPUTATION_SQL}
