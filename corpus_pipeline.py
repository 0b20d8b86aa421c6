"""A corpus pipeline of five training-data stages.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` applies them to
``documents`` in order, each result written as Parquet to the shared folder and
read back as the next stage's input.  All but the last return the columns of
``documents``.  SQL can't express the toxicity model, so there is no SQL; the
tests hold each stage against its operator and against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieve.llm._common import row_key, saved, table, within
from sieve.llm.decontaminate import decontaminated
from sieve.llm.encoding import CACHE
from sieve.llm.jaccard import jaccard_components
from sieve.llm.mixing import mixed
from sieve.llm.token_files import read_token_files, write_token_files
from sieve.llm.toxicity import score_documents


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is in ``keys`` (a column ``key``)."""
    keys = saved(keys.select(F.col("key").alias("_drop")).distinct(), "pipe-drop")
    return docs.join(within(keys), row_key(docs.doc_id, docs.text) == keys._drop, "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated model rejects go."""
    scored = score_documents(docs, table(spark, sf_dir, "labels"), keyed=True)
    return _without(docs, scored.filter("predicted = 1"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8 or more) the smallest id stays, a null id only if the group has no other.

    Of rows equal in id and text one stays; blank documents all stay."""
    keyed = docs.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    found = saved(jaccard_components(keyed, n=5, num=80, den=100, id_col="key").filter("n_shingles > 0")
                  .groupBy(F.col("doc_id").alias("key"), F.col("component_id").alias("group")).count(), "pipe-groups")
    ranked = found.join(keyed.select("key", "doc_id").distinct(), "key") \
        .select("key", "group", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key").alias("rank"))
    least = saved(ranked.groupBy("group").agg(F.min("rank").alias("least")), "pipe-least")
    left = _without(docs, ranked.join(within(least), "group").filter("rank != least"))
    again = saved(found.filter("count > 1").select(F.col("key").alias("_again")), "pipe-again")
    if again.isEmpty():
        return left
    left = left.withColumn("_key", row_key(F.col("doc_id"), F.col("text")))
    here = F.col("_key") == F.col("_again")
    return left.join(within(again), here, "left_anti").unionByName(
        left.join(within(again), here, "left_semi").dropDuplicates(["_key"])).drop("_key")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go, each row by its own text."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of documents by the weights of their sources, in training order."""
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix, in training order; a row for each document in them.

    The mix comes as a table written in training order: its files in order of
    their names, and the rows in them, hold that order.  The cache of chunks is
    half the usual one, as the executors have run four stages by then."""
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")] if docs.inputFiles() else None
    return read_token_files(write_token_files(docs, order=order, cache=CACHE // 2), with_ids=False)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("decontamination", decontamination),
          ("mixing", mixing), ("token_files", token_files)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipe-{name}")
    return docs
