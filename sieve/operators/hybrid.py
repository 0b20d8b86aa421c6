"""H1-H5: score fusion of the text and vector hit lists.

Both inputs are top-k hit tables ``(query_id, rank, doc_id, score)``, so they
are small (queries x k) whatever the corpus size; every step here is a
window or join keyed by ``query_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .limits import cut, query_limits

RRF_K = 60


def minmax(hits: DataFrame) -> DataFrame:
    """H1: ``(s - min) / (max - min)`` per result list; a list whose scores
    are all equal maps to 1; an empty list stays empty."""
    w = Window.partitionBy("query_id")
    mn, mx = F.min("score").over(w), F.max("score").over(w)
    return hits.withColumn("norm", F.when(mx - mn == 0, F.lit(1.0))
                           .otherwise((F.col("score") - mn) / (mx - mn)))


def blend(text_hits: DataFrame, vector_hits: DataFrame, text_weight: float = 0.5,
          vector_weight: float = 0.5, k: int = 20, queries: DataFrame | None = None) -> DataFrame:
    """H2+H3 (+X3 columns): full outer merge by document, missing side counts
    0 and is reported null; ``blended = wt * tn + wv * vn``; ranked by the
    6-place blended score, ties in text-list order, then vector-only order; cut
    at each query's own ``k`` if ``queries`` has one."""
    k, limits = query_limits(queries, k)
    t = minmax(text_hits).select("query_id", "doc_id", F.col("score").alias("text_raw"),
                                 F.col("norm").alias("text_norm"), F.col("rank").alias("text_rank"))
    v = minmax(vector_hits).select("query_id", "doc_id", F.col("score").alias("vector_raw"),
                                   F.col("norm").alias("vector_norm"), F.col("rank").alias("vector_rank"))
    m = t.join(v, ["query_id", "doc_id"], "full_outer")
    blended = (F.lit(text_weight) * F.coalesce("text_norm", F.lit(0.0))
               + F.lit(vector_weight) * F.coalesce("vector_norm", F.lit(0.0)))
    m = m.withColumn("blended", F.round(blended, 6) + F.lit(0.0))
    w = Window.partitionBy("query_id").orderBy(
        F.col("blended").desc(), F.col("text_rank").isNull().asc(),
        F.coalesce("text_rank", "vector_rank").asc())
    r = cut(m.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k), limits)
    return r.select("query_id", "rank", "doc_id", F.col("blended").alias("score"),
                    "text_raw", "text_norm", "vector_raw", "vector_norm",
                    F.lit(text_weight).alias("text_weight"), F.lit(vector_weight).alias("vector_weight"))


def rrf(hit_lists: list[DataFrame], k: int = 20, c: int = RRF_K, queries: DataFrame | None = None) -> DataFrame:
    """H4: reciprocal rank fusion, ``sum(1 / (c + rank))`` over the lists; cut as ``blend``."""
    k, limits = query_limits(queries, k)
    u = hit_lists[0].select("query_id", "doc_id", "rank")
    for h in hit_lists[1:]:
        u = u.unionByName(h.select("query_id", "doc_id", "rank"))
    s = u.groupBy("query_id", "doc_id").agg(F.sum(F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("score"))
    s = s.withColumn("score", F.round("score", 6) + F.lit(0.0))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return cut(s.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k), limits) \
        .select("query_id", "rank", "doc_id", "score")


def overlap(text_hits: DataFrame, vector_hits: DataFrame, hybrid_hits: DataFrame,
            queries: DataFrame) -> DataFrame:
    """H5: per query, list sizes, documents common to text and vector,
    their Jaccard index and the mean absolute rank difference."""
    def cnt(h, name):
        return h.groupBy("query_id").agg(F.count("*").alias(name))
    t = text_hits.select("query_id", "doc_id", F.col("rank").alias("tr"))
    v = vector_hits.select("query_id", "doc_id", F.col("rank").alias("vr"))
    both = t.join(v, ["query_id", "doc_id"]).groupBy("query_id").agg(
        F.count("*").alias("n_common"), F.avg(F.abs(F.col("tr") - F.col("vr"))).alias("mean_rank_diff"))
    base = queries.select("query_id")
    r = (base.join(cnt(text_hits, "n_text"), "query_id", "left")
         .join(cnt(vector_hits, "n_vector"), "query_id", "left")
         .join(cnt(hybrid_hits, "n_hybrid"), "query_id", "left")
         .join(both, "query_id", "left")
         .fillna(0, ["n_text", "n_vector", "n_hybrid", "n_common"]))
    union = F.col("n_text") + F.col("n_vector") - F.col("n_common")
    return r.select("query_id", "n_text", "n_vector", "n_hybrid", "n_common",
                    F.when(union == 0, F.lit(0.0)).otherwise(F.round(F.col("n_common") / union, 6))
                    .alias("jaccard"),
                    F.round("mean_rank_diff", 6).alias("mean_rank_diff"))


def shape_hits(hits: DataFrame, corpus: DataFrame) -> DataFrame:
    """Each hit with its document: ``query_id, rank, doc_id, title, body, tags, score`` (6 places), then ``details``.

    ``details`` is a struct of the further columns of ``hits``, absent if there
    are none.  A hit whose document is gone is left out.  Whole bodies are
    joined for the hits only."""
    own = ("query_id", "rank", "doc_id", "score")
    rest = [c for c in hits.columns if c not in own]
    shaped = hits.select(*own, *([F.struct(*rest).alias("details")] if rest else []))
    docs = corpus.select("doc_id", "title", "body", "tags")
    return shaped.join(docs, "doc_id").select(
        "query_id", "rank", "doc_id", "title", "body", "tags", (F.round("score", 6) + F.lit(0.0)).alias("score"),
        *(["details"] if rest else []))
