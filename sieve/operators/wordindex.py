"""A stored word index that queries are answered from.

``write_word_index`` turns a corpus into three tables below one folder:

* ``postings``: ``bucket, block, term, doc_id, pos, w`` and ``first`` (of the word in the document), a folder per ``bucket``
  (hash of the term) and ``block`` (range of ids, one for about ``block_docs``
  documents if ids are spread evenly), sorted by term and document.  A very common word is split over its blocks and over several
  files of a block.
* ``terms``, the term directory: ``bucket, term, block, df, cf, top_w``, for
  each word and block that holds it the documents and occurrences, and the
  greatest weight it has there; a folder per bucket.
* ``docs``: ``place, doc_id``, the documents numbered by id from 1.

``stored_search`` looks a query table's words up in the directory and reads
only the folders of the buckets and blocks that hold them; word frequencies
come from the directory, so no postings are counted.  Buckets and blocks are
bounded numbers (``buckets``, corpus size by ``block_docs``), never words or
documents, and only those numbers are named on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import materialize
from .analyze import postings
from .query_terms import query_terms
from .textsearch import bounded_broadcast, phrase_items, search_terms

BUCKETS = 64
BLOCK_DOCS = 1 << 20
_SCHEMAS = {
    "postings": "term string, doc_id long, pos int, w double, bucket int, block int",
    "terms": "term string, block int, df long, cf long, top_w double, bucket int",
    "docs": "place long, doc_id long",
    "settings": "buckets int, blocks long, config string",
}


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_word_index(corpus: DataFrame, path: str, buckets: int = BUCKETS, block_docs: int = BLOCK_DOCS, config: str = "simple") -> dict[str, DataFrame]:
    """Write the index of ``corpus (doc_id, title, body)`` and return it as ``read_word_index`` does."""
    from .ingest import assign_ids
    spark = corpus.sparkSession
    path = path.rstrip("/")
    docs = assign_ids(corpus.select("doc_id"), ["doc_id"])
    docs.select(F.col("id").cast("long").alias("place"), "doc_id").write.mode("overwrite").parquet(f"{path}/docs")
    ids = spark.read.schema(_SCHEMAS["docs"]).parquet(f"{path}/docs").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).first()
    blocks = max(1, -(-ids.n // block_docs))
    low, width = ids.lo or 0, max(1, -(-((ids.hi or 0) - (ids.lo or 0) + 1) // blocks))
    block = F.coalesce(F.floor((F.col("doc_id") - low) / width), F.lit(0)).cast("int")
    post = postings(corpus, config).select(term_bucket(F.col("term"), buckets).alias("bucket"), block.alias("block"), "term", "doc_id", "pos", F.col("w").cast("double"))
    # the window takes the ranges and the order that the files need: a word's first occurrence in a document is marked without a shuffle of its own
    in_document = Window.partitionBy("bucket", "block", "term", "doc_id").orderBy("pos")
    post.repartitionByRange("bucket", "block", "term", "doc_id").withColumn("first", F.row_number().over(in_document) == 1) \
        .sortWithinPartitions("bucket", "block", "term", "doc_id", "pos") \
        .write.mode("overwrite").partitionBy("bucket", "block").parquet(f"{path}/postings")
    post = spark.read.schema(_SCHEMAS["postings"] + ", first boolean").parquet(f"{path}/postings")
    post.groupBy("bucket", "term", "block").agg(F.count_if("first").alias("df"), F.count("*").alias("cf"), F.max("w").alias("top_w")) \
        .repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term") \
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms")
    spark.createDataFrame([(buckets, blocks, config)], "buckets int, blocks long, config string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/settings")
    return read_word_index(spark, path)


def read_word_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{name}") for name, schema in _SCHEMAS.items()}


def lookup(index: dict[str, DataFrame], words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(postings, frequencies)`` of the words in ``words (term)``.

    ``postings`` reads only the folders of buckets and blocks that hold one of
    them; ``frequencies`` is ``term, df, cf, top_w``."""
    buckets = index["settings"].first().buckets
    words = bounded_broadcast(materialize(words.select("term").distinct().withColumn("bucket", term_bucket(F.col("term"), buckets)), "index-words"))
    used = [r.bucket for r in words.select("bucket").distinct().collect()]
    found = materialize(index["terms"].where(F.col("bucket").isin(used)).join(words, ["bucket", "term"]), "index-found")
    folders = found.select("bucket", "block").distinct().groupBy("block").agg(F.sort_array(F.collect_list("bucket")).alias("buckets")).collect()
    keep = F.lit(False)
    by_buckets: dict[tuple, list] = {}
    for r in folders:  # blocks that need the same buckets are named together
        by_buckets.setdefault(tuple(r.buckets), []).append(r.block)
    for some, blocks in by_buckets.items():
        keep = keep | (F.col("bucket").isin(list(some)) & F.col("block").isin(blocks))
    post = index["postings"].where(keep).join(words, ["bucket", "term"], "left_semi")
    freq = found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.max("top_w").alias("top_w"))
    return post.select("doc_id", "term", "pos", "w"), freq


def stored_search(index: dict[str, DataFrame], queries: DataFrame, k: int = 20, plain: bool = False, ranked: bool = True) -> DataFrame:
    """``search_text`` over a stored index: ``(query_id, rank, doc_id, score)``, or ``(query_id, doc_id)`` unranked."""
    q = queries.where(~is_blank(F.col("q")))
    qt = materialize(query_terms(q, config=index["settings"].first().config, plain=plain), "query-terms")
    post, freq = lookup(index, qt.select("term"))
    return search_terms(q, qt, post, k=k, ranked=ranked, freq=materialize(freq.select("term", "cf"), "query-words"), docs=index["docs"])


def stored_phrases(index: dict[str, DataFrame], queries: DataFrame) -> DataFrame:
    """``phrase_matches`` over a stored index."""
    qt = phrase_items(queries, index["settings"].first().config)
    post, freq = lookup(index, qt.select("term"))
    from .textsearch import match_hits
    return match_hits(post, qt, freq=materialize(freq.select("term", "cf"), "query-words"))[2]
