"""Registered query plans: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every plan reads the supplied tables (or what Spark derives from them) in
full.  Output columns are flat scalars with the same names as the SQL oracle
in ``oracle.py``; scores are rounded to 6 places (as the reference shapes
them) before ranking, ties broken by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import embed_tokens, is_blank
from ..session import materialize
from ..operators import embedding as emb
from ..operators import vectorsearch as vs
from ..sources.tables import load_corpus, queries_from_benchmark, read_table

K = 20


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return load_corpus(spark, sf)


def _bench_queries(spark: SparkSession, sf: str) -> DataFrame:
    q = queries_from_benchmark(read_table(spark, sf, "benchmark"), K)
    return q.where(~is_blank(F.col("q")))


def _embed_text(corpus: DataFrame) -> DataFrame:
    return corpus.select("doc_id", emb.embedding_text(F.col("title"), F.col("body")).alias("text"))


# -- V1-V4 -------------------------------------------------------------------

def q_embed_tokens(spark, sf):
    t = _embed_text(_corpus(spark, sf)).select("doc_id", embed_tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"),
                    F.size(F.array_distinct("t")).alias("n_distinct"),
                    F.array_join("t", " ").alias("tokens"))


def q_hash_buckets(spark, sf):
    t = _embed_text(_corpus(spark, sf)).select(F.explode(embed_tokens(F.col("text"))).alias("token"))
    return emb.hash_buckets(t.distinct(), "token", emb.DIMS)


def q_embed_sparse(spark, sf):
    sp = emb.embed_sparse(_embed_text(_corpus(spark, sf)), "doc_id", F.col("text"), emb.DIMS)
    return sp.select("doc_id", "dim", F.round("value", 6).alias("value"))


def q_embed_documents(spark, sf):
    v = emb.embed_corpus(_corpus(spark, sf))
    return (v.select("doc_id", F.posexplode("vec").alias("dim", "value"))
            .where(F.col("value") != 0)
            .select("doc_id", F.col("dim").cast("int").alias("dim"), F.round("value", 6).alias("value")))


# -- V5-V7, V10, X2 ----------------------------------------------------------

def _cosine_docs(spark, sf):
    docs = emb.embed_corpus(_corpus(spark, sf))
    qv = emb.embed_queries(_bench_queries(spark, sf))
    return qv, vs.knn(qv, docs, k=K, metric="cosine")


def q_vector_cosine_docs(spark, sf):
    return _cosine_docs(spark, sf)[1]


def _embeddings_knn(spark, sf, metric):
    e = read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("vec"))
    q = e.select(F.col("doc_id").alias("query_id"), "vec")
    return vs.knn(q, e, k=K, metric=metric, k_col=None, exclude_self=True)


def q_vector_cosine(spark, sf):
    return _embeddings_knn(spark, sf, "cosine")


def q_vector_l2(spark, sf):
    return _embeddings_knn(spark, sf, "l2")


def q_vector_ip(spark, sf):
    return _embeddings_knn(spark, sf, "ip")


def q_query_vector_dims(spark, sf):
    qv = emb.embed_queries(_bench_queries(spark, sf))
    return vs.top_dims(qv).select("query_id", "rank", "dim", F.round("value", 6).alias("value"))


def q_explain_vector(spark, sf):
    qv, hits = _cosine_docs(spark, sf)
    norms = vs.vector_norms(qv)
    return (hits.join(norms, "query_id")
            .select("query_id", "rank", "doc_id",
                    F.round(F.lit(1.0) - F.col("score"), 6).alias("cosine_distance"),
                    F.col("score").alias("cosine_similarity"),
                    F.round("query_norm", 6).alias("query_norm")))


QUERIES = {
    "embed_tokens": q_embed_tokens,
    "hash_buckets": q_hash_buckets,
    "embed_sparse": q_embed_sparse,
    "embed_documents": q_embed_documents,
    "vector_cosine_docs": q_vector_cosine_docs,
    "vector_cosine": q_vector_cosine,
    "vector_l2": q_vector_l2,
    "vector_ip": q_vector_ip,
    "query_vector_dims": q_query_vector_dims,
    "explain_vector": q_explain_vector,
}


# -- T1, T3-T8, R1-R3, R5, X1 ------------------------------------------------

from ..functions.text import word_tokens  # noqa: E402
from ..operators import analyze as an  # noqa: E402
from ..operators import query_terms as qtm  # noqa: E402
from ..operators import textsearch as ts  # noqa: E402
from ..operators import wordindex as wi  # noqa: E402
from ..sources.tables import text_queries_from_benchmark  # noqa: E402


def _index(spark, sf, corpus=None):
    """Postings index of the corpus, written once per plan (the reference
    stores its lexeme vector on write as well)."""
    return materialize(an.postings(corpus if corpus is not None else _corpus(spark, sf)), "postings")


def _text_queries(spark, sf):
    return text_queries_from_benchmark(read_table(spark, sf, "benchmark"), K)


def q_tokens_simple(spark, sf):
    c = _corpus(spark, sf)
    w = c.select("doc_id", F.concat(word_tokens(F.col("title")), word_tokens(F.col("body"))).alias("w"))
    return w.select("doc_id", F.size("w").alias("n_words"),
                    F.size(F.array_distinct("w")).alias("n_lexemes"),
                    F.array_join(F.array_sort(F.array_distinct("w")), " ").alias("lexemes"))


def q_weighted_postings(spark, sf):
    return an.postings(_corpus(spark, sf)).select("doc_id", "term", "pos", "weight")


def q_term_stats(spark, sf):
    return an.term_stats(an.postings(_corpus(spark, sf)))


def q_query_terms(spark, sf):
    q = _text_queries(spark, sf).where(~is_blank(F.col("q")))
    return qtm.query_terms(q)


def q_search_match(spark, sf):
    return ts.search_text(_corpus(spark, sf), _text_queries(spark, sf), ranked=False, post=_index(spark, sf))


def q_search_ranked(spark, sf):
    return ts.search_text(_corpus(spark, sf), _text_queries(spark, sf), k=K, post=_index(spark, sf))


def q_search_plain(spark, sf):
    return ts.search_text(None, _bench_queries(spark, sf), k=K, plain=True, post=_index(spark, sf))


def q_search_phrase(spark, sf):
    return ts.phrase_matches(_index(spark, sf), _bench_queries(spark, sf))


def q_blank_queries(spark, sf):
    b = read_table(spark, sf, "benchmark")
    variants = b.select(F.explode(F.array(
        F.struct((F.col("item_id") * 2).alias("query_id"), F.col("text").alias("q")),
        F.struct((F.col("item_id") * 2 + 1).alias("query_id"),
                 F.regexp_replace(F.coalesce("text", F.lit("")), r"\S", "").alias("q")))).alias("x")
    ).select("x.*")
    return variants.select("query_id", is_blank(F.col("q")).alias("blank"))


def q_explain_text(spark, sf):
    c = _corpus(spark, sf)
    q = _text_queries(spark, sf).where(~is_blank(F.col("q")))
    hits = ts.search_text(c, q, k=K, post=_index(spark, sf, c))
    qt = qtm.query_terms(q)
    lex = an.doc_lexemes(c.join(hits.select("doc_id").distinct(), "doc_id", "left_semi"))
    ql = qtm.query_lexemes(qt)
    pt = qtm.parsed_query_text(qt)
    j = hits.join(ql, "query_id").join(pt, "query_id").join(lex, "doc_id")
    return j.select(
        "query_id", "rank", "doc_id", "score", "parsed_query",
        F.array_join(F.array_sort(F.array_intersect("lexemes", "query_lexemes")), " ").alias("matched_lexemes"),
        F.substring(F.array_join(F.transform("lexemes", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), " "),
                    1, 280).alias("tsvector_preview"))


QUERIES.update({
    "tokens_simple": q_tokens_simple,
    "weighted_postings": q_weighted_postings,
    "term_stats": q_term_stats,
    "query_terms": q_query_terms,
    "search_match": q_search_match,
    "search_ranked": q_search_ranked,
    "search_plain": q_search_plain,
    "search_phrase": q_search_phrase,
    "blank_queries": q_blank_queries,
    "explain_text": q_explain_text,
})


# -- H1-H5, X3 ---------------------------------------------------------------

from ..operators import hybrid as hy  # noqa: E402


def _both_lists(spark, sf, q=None):
    c = _corpus(spark, sf)
    q = _bench_queries(spark, sf) if q is None else q
    text = ts.search_text(c, q, k=K, post=_index(spark, sf, c))
    qv = emb.embed_queries(q)
    vec = vs.knn(qv, emb.embed_corpus(c), k=K, metric="cosine")
    return q, text, vec


def q_minmax_scores(spark, sf):
    _, text, vec = _both_lists(spark, sf)
    t = hy.minmax(text).select("query_id", F.lit("text").alias("engine"), "doc_id", "score",
                               F.round("norm", 6).alias("norm"))
    v = hy.minmax(vec).select("query_id", F.lit("vector").alias("engine"), "doc_id", "score",
                              F.round("norm", 6).alias("norm"))
    return t.unionByName(v)


def q_hybrid_blend(spark, sf):
    _, text, vec = _both_lists(spark, sf)
    return hy.blend(text, vec, k=K).select("query_id", "rank", "doc_id", "score")


def q_explain_hybrid(spark, sf):
    _, text, vec = _both_lists(spark, sf)
    b = hy.blend(text, vec, k=K)
    return b.select("query_id", "rank", "doc_id", "score", "text_raw",
                    F.round("text_norm", 6).alias("text_norm"), "vector_raw",
                    F.round("vector_norm", 6).alias("vector_norm"), "text_weight", "vector_weight")


def q_hybrid_rrf(spark, sf):
    _, text, vec = _both_lists(spark, sf)
    return hy.rrf([text, vec], k=K)


def q_engine_overlap(spark, sf):
    q, text, vec = _both_lists(spark, sf)
    return hy.overlap(text, vec, hy.blend(text, vec, k=K), q)


def _varied_limits(q, id_col):
    """``q`` with limits from null, -5, 0, 5, 25 and 50 in turn."""
    turn = F.pmod(F.col(id_col), F.lit(6))
    return q.withColumn("k", F.when(turn == 0, None).when(turn == 1, -5).when(turn == 2, 0).when(turn == 3, 5)
                        .when(turn == 4, 25).otherwise(50).cast("int"))


def _benchmark_words(spark, sf):
    """``id, q``: every distinct word of the benchmark, numbered from 1 in order."""
    words = read_table(spark, sf, "benchmark").select(F.explode(word_tokens(F.col("text"))).alias("q")).distinct()
    return materialize(ing.assign_ids(words, ["q"]).select("id", "q"), "benchmark-words")


def _word_pairs(words):
    """``id, q, q2``: each word and the next one."""
    return words.join(words.select((F.col("id") - 1).alias("id"), F.col("q").alias("q2")), "id")


def _shapes(rows, *queries):
    """``query_id, q`` from the given query texts of each row, the first with id 2 * id, the second with the next."""
    shapes = F.array(*[F.struct((F.col("id") * 2 + i).alias("query_id"), q.alias("q")) for i, q in enumerate(queries)])
    return rows.select(F.explode(shapes).alias("x")).select("x.*")


def q_search_limits(spark, sf):
    """Every word of the benchmark as a query."""
    words = _benchmark_words(spark, sf).withColumnRenamed("id", "query_id")
    return ts.search_text(_corpus(spark, sf), _varied_limits(words, "query_id"), k=K, post=_index(spark, sf))


def q_search_negated(spark, sf):
    """``-word`` (even ids) and ``word or -next`` (odd ids) for every word of the benchmark and the next one."""
    q = _shapes(_word_pairs(_benchmark_words(spark, sf)), F.concat(F.lit("-"), "q"), F.concat("q", F.lit(" or -"), "q2"))
    return ts.search_text(_corpus(spark, sf), _varied_limits(q, "query_id"), k=K, post=_index(spark, sf))


def q_search_words(spark, sf):
    """Every word of the benchmark, alone and with the next one as an alternative, over a stored index."""
    words = _benchmark_words(spark, sf)
    q = words.select((F.col("id") * 2).alias("query_id"), "q") \
        .unionByName(_shapes(_word_pairs(words), F.col("q"), F.concat("q", F.lit(" or "), "q2")).where("query_id % 2 = 1"))
    return wi.stored_search(_stored(spark, sf), q, k=K)


def _stored(spark, sf):
    return wi.write_word_index(_corpus(spark, sf), _scratch(spark, "word-index"), block_docs=4096)


def q_stored_search(spark, sf):
    return wi.stored_search(_stored(spark, sf), _text_queries(spark, sf), k=K)


def q_stored_phrase(spark, sf):
    return wi.stored_phrases(_stored(spark, sf), _bench_queries(spark, sf))


def q_vector_limits(spark, sf):
    q = _varied_limits(_bench_queries(spark, sf), "query_id")
    return vs.knn(emb.embed_queries(q), emb.embed_corpus(_corpus(spark, sf)), k=K, metric="cosine")


def q_hybrid_limits(spark, sf):
    q, text, vec = _both_lists(spark, sf, _varied_limits(_bench_queries(spark, sf), "query_id"))
    return hy.rrf([text, vec], k=K, queries=q)


QUERIES.update({
    "search_limits": q_search_limits,
    "search_words": q_search_words,
    "stored_search": q_stored_search,
    "stored_phrase": q_stored_phrase,
    "search_negated": q_search_negated,
    "vector_limits": q_vector_limits,
    "hybrid_limits": q_hybrid_limits,
    "minmax_scores": q_minmax_scores,
    "hybrid_blend": q_hybrid_blend,
    "explain_hybrid": q_explain_hybrid,
    "hybrid_rrf": q_hybrid_rrf,
    "engine_overlap": q_engine_overlap,
})


# -- R4, R6, R7, X4-X6 -------------------------------------------------------

from ..functions.text import limit_rule, snippet  # noqa: E402
from ..operators import fuzzy as fz  # noqa: E402


def q_search_overlap(spark, sf):
    return fz.overlap_search(_corpus(spark, sf), _bench_queries(spark, sf), k=K)


def q_fuzzy_title(spark, sf):
    return fz.fuzzy_title(_corpus(spark, sf), _bench_queries(spark, sf), threshold=0.3)


def q_fuzzy_title_k(spark, sf):
    """The most similar titles of each item, with limits of their own."""
    return fz.fuzzy_title(_corpus(spark, sf), _varied_limits(_bench_queries(spark, sf), "query_id"), threshold=0.1, k=K)


def q_title_ilike(spark, sf):
    """Every distinct word of the benchmark as a pattern, by its number."""
    words = _benchmark_words(spark, sf).select(F.col("id").alias("query_id"), F.col("q").alias("pattern"))
    return fz.ilike_matches(_corpus(spark, sf), words, "title")


def q_limit_rule(spark, sf):
    b = read_table(spark, sf, "benchmark")
    k_in = (F.pmod(F.col("item_id"), F.lit(7)) * 10 - 20).cast("int")
    return b.select(F.col("item_id").alias("query_id"), k_in.alias("k_requested"),
                    limit_rule(k_in).alias("k_used"))


def q_snippets(spark, sf):
    return _corpus(spark, sf).select("doc_id", snippet(F.col("body")).alias("snippet"))


def q_shaped_hits(spark, sf):
    c = _corpus(spark, sf)
    hits = q_vector_cosine_docs(spark, sf)
    return (hits.join(c, "doc_id")
            .select("query_id", "rank", "doc_id", "title", F.array_join("tags", ",").alias("tags"),
                    snippet(F.col("body")).alias("snippet"), F.round("score", 6).alias("score")))


def _flat(shaped):
    return shaped.withColumn("tags", F.array_join("tags", ","))


def q_shaped_text(spark, sf):
    return _flat(hy.shape_hits(q_search_ranked(spark, sf), _corpus(spark, sf)))


def q_shaped_hybrid(spark, sf):
    shaped = _flat(hy.shape_hits(q_explain_hybrid(spark, sf), _corpus(spark, sf)))
    return shaped.select(*[c for c in shaped.columns if c != "details"], "details.*")


def q_explain_dims(spark, sf):
    """Vector hits with distance, similarity, norm and the query's five largest dimensions."""
    dims = q_query_vector_dims(spark, sf).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "dim", "value"))).alias("d"))
    shown = F.array_join(F.transform("d", lambda x: F.concat(x["dim"].cast("string"), F.lit(":"), F.format_string("%.6f", x["value"]))), " ")
    return q_explain_vector(spark, sf).join(dims.select("query_id", shown.alias("top_dims")), "query_id", "left")


QUERIES.update({
    "shaped_text": q_shaped_text,
    "shaped_hybrid": q_shaped_hybrid,
    "explain_dims": q_explain_dims,
    "search_overlap": q_search_overlap,
    "fuzzy_title": q_fuzzy_title,
    "fuzzy_title_k": q_fuzzy_title_k,
    "title_ilike": q_title_ilike,
    "limit_rule": q_limit_rule,
    "snippets": q_snippets,
    "shaped_hits": q_shaped_hits,
})


# -- S1-S12 ------------------------------------------------------------------

import uuid  # noqa: E402

from ..operators import ingest as ing  # noqa: E402
from ..session import ensure_checkpoint_dir  # noqa: E402
from ..sources.tables import corpus_from_pages  # noqa: E402


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sieve-{name}-{uuid.uuid4().hex}"


def q_jsonl_roundtrip(spark, sf):
    from pyspark.sql import types as T
    path = _scratch(spark, "jsonl")
    ing.write_jsonl(_corpus(spark, sf).select("doc_id", "title", "body", "tags"), path)
    schema = T.StructType([T.StructField("doc_id", T.LongType(), True)] + list(ing.JSONL_SCHEMA.fields))
    back = ing.read_jsonl(spark, path, schema)
    return back.select("doc_id", "title", "body", F.array_join("tags", ",").alias("tags"))


def _index_summary(tables):
    post = tables["postings"].groupBy("doc_id").agg(F.count("*").alias("n_postings"),
                                                    F.countDistinct("term").alias("n_lexemes"))
    vec = tables["vectors"].select("doc_id", F.size(F.filter("vec", lambda x: x != 0)).alias("n_dims"))
    return (tables["corpus"].select("doc_id", "title").join(post, "doc_id", "left")
            .join(vec, "doc_id", "left").fillna(0, ["n_postings", "n_lexemes"]))


def q_index_documents(spark, sf):
    tables = ing.index_documents(_corpus(spark, sf), _scratch(spark, "index"))
    return _index_summary(tables)


def _streamed(spark, sf):
    """The corpus as JSON files indexed batch by batch."""
    from ..streaming.incremental import read_index, start_index_stream
    src = _scratch(spark, "stream-src")
    _corpus(spark, sf).select("doc_id", "title", "body", "tags").repartition(4, "doc_id").write.json(src)
    out, ck = _scratch(spark, "stream-out"), _scratch(spark, "stream-ck")
    start_index_stream(spark, src, out, ck).awaitTermination()
    return read_index(spark, out)


def q_stream_index(spark, sf):
    return _index_summary(_streamed(spark, sf))


def q_stream_search(spark, sf):
    """The web-search queries over an index that a stream has written."""
    tables = _streamed(spark, sf)
    return ts.search_text(tables["corpus"], _text_queries(spark, sf), k=K, post=tables["postings"])


def q_assign_ids(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "lang")
    return ing.assign_ids(d, ["lang", "doc_id"]).select("id", "doc_id")


def q_union_sources(spark, sf):
    docs = _corpus(spark, sf).select(F.col("doc_id").alias("orig_id"), "title")
    pages = corpus_from_pages(read_table(spark, sf, "pages")).select(F.col("doc_id").alias("orig_id"), "title")
    u = ing.union_sources([docs, pages])
    return ing.assign_ids(u, ["source_order", "orig_id"]).select("id", "source_order", "orig_id", "title")


def q_lookup_ids(spark, sf):
    ids = read_table(spark, sf, "labels").select("doc_id")
    r = ing.lookup_ids(_corpus(spark, sf), ids)
    return r.select("doc_id", "title", F.col("title").isNotNull().alias("found"))


def q_corpus_count(spark, sf):
    return ing.corpus_count(_corpus(spark, sf))


def q_clean_corpus(spark, sf):
    c = _corpus(spark, sf).withColumn("source", F.col("tags")[1])
    rec = c.select("doc_id", "title", "body", F.col("source").alias("category"),
                   F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("category_order"),
                   F.col("doc_id").alias("listing_order"))
    return ing.clean_corpus(rec).select("doc_id", "title", "tag", F.length("body").alias("n_chars"))


QUERIES.update({
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "index_documents": q_index_documents,
    "stream_index": q_stream_index,
    "stream_search": q_stream_search,
    "assign_ids": q_assign_ids,
    "union_sources": q_union_sources,
    "lookup_ids": q_lookup_ids,
    "corpus_count": q_corpus_count,
    "clean_corpus": q_clean_corpus,
})


# -- V8, V9 ------------------------------------------------------------------

from ..operators import ivf  # noqa: E402

IVF_LISTS = 100


def _ivf(spark, sf):
    c = _corpus(spark, sf)
    docs = materialize(emb.embed_corpus(c), "vectors")
    cents, assigned = ivf.build_ivf(docs, lists=IVF_LISTS)
    assigned = materialize(assigned, "ivf")
    qv = materialize(emb.embed_queries(_bench_queries(spark, sf)), "qvec")
    return docs, qv, cents, assigned


def q_vector_ivf(spark, sf):
    _, qv, cents, assigned = _ivf(spark, sf)
    return ivf.ivf_search(qv, cents, assigned, k=K, nprobe=len(cents), k_col="k")


def q_ann_recall(spark, sf):
    docs, qv, cents, assigned = _ivf(spark, sf)
    approx = ivf.ivf_search(qv, cents, assigned, k=K, nprobe=max(1, len(cents) // 10), k_col="k")
    exact = vs.knn(qv, docs, k=K, metric="cosine")
    return ivf.recall_at_k(approx, exact, K)


STORED_LISTS, PROBED_LISTS = 10, 3


def _list_search(spark, sf):
    docs = materialize(emb.embed_corpus(_corpus(spark, sf)), "vectors")
    cents, stored = ivf.build_lists(docs, _scratch(spark, "vector-lists"), lists=STORED_LISTS)
    qv = materialize(emb.embed_queries(_bench_queries(spark, sf)), "qvec")
    return docs, qv, ivf.ivf_search(qv, cents, stored, k=K, nprobe=PROBED_LISTS, k_col="k")


def q_vector_lists(spark, sf):
    return _list_search(spark, sf)[2]


def q_list_recall(spark, sf):
    docs, qv, approx = _list_search(spark, sf)
    return ivf.recall_at_k(approx, vs.knn(qv, docs, k=K, metric="cosine"), K)


QUERIES.update({
    "vector_lists": q_vector_lists,
    "list_recall": q_list_recall,
    "vector_ivf": q_vector_ivf,
    "ann_recall": q_ann_recall,
})


# -- T2 (fixture-checked: the SQL oracle has no English stemmer) --------------

def q_lexemes_english(spark, sf):
    p = an.postings(_corpus(spark, sf), config="english")
    return p.groupBy("doc_id").agg(F.count("*").alias("n_postings"),
                                   F.array_join(F.array_sort(F.collect_set("term")), " ").alias("lexemes"))


QUERIES["lexemes_english"] = q_lexemes_english
