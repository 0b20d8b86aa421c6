"""Sources, sinks and set-oriented indexing.

The reference inserts documents one at a time; here a whole table of new
documents is indexed by one job that writes the three derived tables
(corpus, postings, vectors) from the same source DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .analyze import postings
from .embedding import embed_corpus

JSONL_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
])


# -- S1, S2 ------------------------------------------------------------------

def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = JSONL_SCHEMA,
               limit: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """One document per line, explicit schema, a malformed line fails the
    job (FAILFAST).  Blank lines are skipped by the reader.  ``limit`` needs
    an order key (files have no line numbers in a distributed read)."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if limit is not None:
        if not order_by:
            raise ValueError("limit needs order_by")
        df = df.orderBy(*order_by).limit(limit)
    return df


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").json(path)


# -- S4, S5, S7 --------------------------------------------------------------

def with_defaults(docs: DataFrame) -> DataFrame:
    """Tags default to ``[]``; null title / body become ``''``."""
    return docs.select(
        *[c for c in docs.columns if c not in ("title", "body", "tags")],
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("body"), F.lit("")).alias("body"),
        (F.coalesce(F.col("tags"), F.array().cast("array<string>"))
         if "tags" in docs.columns else F.array().cast("array<string>")).alias("tags"))


def assign_ids(docs: DataFrame, order: list[str], id_col: str = "id", start: int = 1) -> DataFrame:
    """Consecutive ids from ``start`` in ``order``, without a global
    single-partition window.

    Range partitioning on the order key, then (materialised, so both passes
    see the same rows) the row index inside each partition plus a running
    count of the rows in earlier partitions -- a table with one row per
    partition."""
    spark = docs.sparkSession
    n = max(1, spark.sparkContext.defaultParallelism)
    ranged = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_p", F.spark_partition_id()).withColumn(
        "_i", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    ranged = materialize(ranged, "ids")
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    offs = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    offs = offs.fillna(0, ["_off"])
    out = ranged.join(F.broadcast(offs), "_p").withColumn(
        id_col, (F.col("_off") + F.col("_i") + F.lit(start)).cast("long"))
    return out.drop("_p", "_i", "_off")


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """Sources in the given order (``source_order`` = list position)."""
    out = None
    for i, s in enumerate(sources):
        s = s.withColumn("source_order", F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out


# -- S3, S6, S9, S11 ---------------------------------------------------------

def index_documents(docs: DataFrame, out_dir: str | None = None, dims: int = 128,
                    config: str = "simple") -> dict[str, DataFrame]:
    """S3: ``docs(doc_id, title, body, tags)`` -> corpus, postings, vectors.

    With ``out_dir`` the three tables are written (``overwrite``: S6 replace
    all; ``replace_index`` is the form whose readers never see a mixture) and read back.  Postings are range-partitioned on ``(term, doc_id)``
    -- sorted by term for row-group pruning, and a very common word is split
    over several tasks instead of landing on one.  S11 (rebuild after load) is
    ``ivf.build_ivf`` / ``analyze.term_stats`` run on the written tables.
    The corpus is read once per derived table; nothing is collected."""
    corpus = with_defaults(docs).select("doc_id", "title", "body", "tags",
                                        F.current_timestamp().alias("created_at"))
    post = postings(corpus, config)
    vecs = embed_corpus(corpus, dims=dims)
    tables = {"corpus": corpus, "postings": post, "vectors": vecs}
    if out_dir is None:
        return tables
    spark = docs.sparkSession
    out = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        if name == "postings":
            n = max(1, spark.sparkContext.defaultParallelism)
            (df.repartitionByRange(n, "term", "doc_id").sortWithinPartitions("term", "doc_id", "pos")
             .write.mode("overwrite").parquet(path))
        else:
            df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def replace_index(docs: DataFrame, root: str, dims: int = 128, config: str = "simple") -> dict[str, DataFrame]:
    """Index ``docs`` beside what ``root`` holds, then make it the current version.

    Each call writes a folder of its own; only when all its tables stand does a
    row ``(version, folder)`` join the ``versions`` table, in one committed file.
    A reader thus sees the old tables or the new ones, a failed or lost job
    leaves the old ones current, and tables opened before go on reading their
    own files.  One writer at a time."""
    spark = docs.sparkSession
    root = root.rstrip("/")
    current = _current(spark, root)
    version, folder = (current["version"] + 1 if current else 1), f"index-{uuid.uuid4().hex}"
    index_documents(docs, f"{root}/{folder}", dims, config)
    spark.createDataFrame([(version, folder)], _VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return read_current(spark, root)


def read_current(spark: SparkSession, root: str) -> dict[str, DataFrame] | None:
    """The tables of the last version that ``replace_index`` completed under ``root``; None before the first."""
    current = _current(spark, root.rstrip("/"))
    if current is None:
        return None
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{current['folder']}/{name}") for name in ("corpus", "postings", "vectors")}


_VERSIONS = "version long, folder string"


def _current(spark, root):
    try:
        versions = spark.read.schema(_VERSIONS).parquet(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return versions.agg(F.max(F.struct("version", "folder")).alias("m")).first()["m"]


def corpus_count(corpus: DataFrame) -> DataFrame:
    """S9."""
    return corpus.agg(F.count("*").alias("n"))


def lookup_ids(corpus: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents for a table of ids; a miss shows as nulls (left join).
    ``left_semi`` would drop misses instead."""
    return ids.select(id_col).distinct().join(corpus, id_col, "left")


# -- S10 ---------------------------------------------------------------------

def clean_corpus(records: DataFrame, cap: int | None = None, min_chars: int = 120) -> DataFrame:
    """S10 on ``records(doc_id, title, body, category, category_order, listing_order)``.

    Order matters: per-category cap first, if any (top-``cap`` by listing order, a
    ``row_number() <= cap`` that Spark limits map-side), then de-duplication
    by title where the first category wins (an aggregate, so a title shared
    by a third of all rows is combined map-side), and only then the text
    filters -- a title whose text is dropped is not retried elsewhere.  The
    tag is the category with ``_`` as space, lower-cased."""
    capped = records
    if cap is not None:
        w = Window.partitionBy("category").orderBy("listing_order", "doc_id")
        capped = records.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cap).drop("_r")
    first = (capped.groupBy("title").agg(F.min(F.struct("category_order", "listing_order", "doc_id"))
                                         .alias("_m"))
             .select(F.col("_m.doc_id").alias("doc_id")))
    kept = capped.join(first, "doc_id", "left_semi")
    kept = kept.where(F.col("body").isNotNull() & (F.length("body") >= min_chars))
    return kept.select("doc_id", "title", "body",
                       F.lower(F.regexp_replace("category", "_", " ")).alias("tag"))
