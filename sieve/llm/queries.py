"""The registered queries of this subpackage: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table
from .alignment import aligned_tokens
from .decontaminate import leaks
from .jaccard import jaccard_components
from .mixing import curriculum
from .prefix_trie import prefix_trie, rebuilt
from .secrets import scan
from .simhash import simhash_components
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .token_files import read_token_files, write_token_files
from .tool_calls import calls_of_conversations, link_calls
from .topk import scaled, top_k
from .toxicity import score_documents


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_calls(*calls_of_conversations(table(spark, sf_dir, "conversations")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.element_at("copies", 1)
    return curriculum(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", F.size("copies").alias("passes"),
        F.round(F.when(F.size("copies") > 0, first["position"]), 6).alias("position")) \
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents")), with_ids=False)


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), scaled(F.col("embedding")).alias("terms"))
    return top_k(rows.filter("id % 100 = 0"), rows, 10).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_tokens(table(spark, sf_dir, "documents"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_tool_calls, op2_suffix_dedup, op3_curriculum_mix, op4_benchmark_leaks, op5_token_files, op6_topk_search, op7_ngram_jaccard, op8_secret_scan,
    op9_token_counts, op10_toxicity, op11_token_alignment, op12_simhash_dedup, op13_prefix_trie)}
