"""Readers for the supplied Parquet tables and the corpus / query views.

The reference stores ``(id, title, body, tags, created_at)`` documents and
answers a query string.  The supplied ``documents`` table has no title, so the
corpus view derives one with a fixed rule that the SQL oracle repeats:

* title = text before the first newline, ``''`` when there is none
* body  = text after the first newline, the whole text when there is none
* tags  = ``array(lang, source)``

Queries are always a *table* ``(query_id, q, k)``; a single query is a one-row
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_K = 20
# Fixed creation time so results are repeatable (the reference stamps now()).
CREATED_AT = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one supplied table.  ``spread=True`` round-robins an input that
    arrives in fewer splits than the cluster has cores (the test tables are
    single files); a real multi-file input is left as the scan splits it."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        par = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < par:
            df = df.repartition(par)
    return df


def split_title(text: Column) -> Column:
    nl = F.instr(text, "\n")
    return F.when(nl > 0, F.substring_index(text, "\n", 1)).otherwise(F.lit(""))


def split_body(text: Column) -> Column:
    nl = F.instr(text, "\n")
    return F.when(nl > 0, F.substr(text, nl + 1)).otherwise(text)


def corpus_from_documents(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text, lang, source, ...)`` -> corpus view."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return (documents
            .select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("text"),
                    F.col("lang"), F.col("source"))
            .select("doc_id",
                    split_title(F.col("text")).alias("title"),
                    split_body(F.col("text")).alias("body"),
                    F.array(F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))).alias("tags"),
                    F.to_timestamp(F.lit(CREATED_AT)).alias("created_at")))


def corpus_from_pages(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> corpus view: ``<title>`` capture and
    the html with script/style blocks and tags removed as body."""
    html = F.coalesce(F.col("html"), F.lit(""))
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    body = F.regexp_replace(html, r"(?is)<(script|style|title)[^>]*>.*?</\1>", " ")
    body = F.regexp_replace(body, r"(?s)<[^>]*>", " ")
    body = F.trim(F.regexp_replace(body, r"\s+", " "))
    return pages.select(F.col("page_id").cast("long").alias("doc_id"), title.alias("title"),
                        body.alias("body"), F.array().cast("array<string>").alias("tags"),
                        F.to_timestamp(F.lit(CREATED_AT)).alias("created_at"))


def load_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_from_documents(read_table(spark, sf_dir, "documents", spread=True))


def queries_from_benchmark(benchmark: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """``benchmark(item_id, text)`` -> ``queries(query_id, q, k)``: whole item
    text as the query string (known-item retrieval)."""
    return benchmark.select(F.col("item_id").cast("long").alias("query_id"),
                            F.coalesce(F.col("text"), F.lit("")).alias("q"),
                            F.lit(k).cast("int").alias("k"))


N_TEXT_SHAPES = 4


def text_queries_from_benchmark(benchmark: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Web-search query strings built from whole benchmark items.

    ``query_id = item_id * 4 + shape`` with shapes
    0 ``text``                       (AND of every word),
    1 ``"text"``                     (the item as one phrase),
    2 ``text or next``               (two AND clauses, next = item_id + 1),
    3 ``text -"next"``               (the item, without the next item as a phrase).
    The next item is found by an equi-join on ``item_id + 1``.
    """
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                         F.regexp_replace(F.coalesce("text", F.lit("")), '"', " ").alias("t"))
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), F.col("t").alias("t2"))
    j = b.join(nxt, "item_id", "left")
    shapes = [
        (0, F.col("t")),
        (1, F.concat(F.lit('"'), F.col("t"), F.lit('"'))),
        (2, F.concat(F.col("t"), F.lit(" or "), F.coalesce("t2", F.lit("")))),
        (3, F.concat(F.col("t"), F.lit(' -"'), F.coalesce("t2", F.lit("")), F.lit('"'))),
    ]
    arr = F.array(*[F.struct(F.lit(s).alias("shape"), e.alias("q")) for s, e in shapes])
    return (j.select("item_id", F.explode(arr).alias("x"))
            .select((F.col("item_id") * N_TEXT_SHAPES + F.col("x.shape")).alias("query_id"),
                    F.col("x.q").alias("q"), F.lit(k).cast("int").alias("k")))
