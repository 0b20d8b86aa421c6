"""One limit rule in every engine; negated clauses; phrases after stop words; close vectors."""

from sieve.operators import textsearch as ts
from sieve.operators import vectorsearch as vs
from sieve.operators.hybrid import rrf


def _corpus(spark, bodies):
    return spark.createDataFrame([(i, "", b) for i, b in enumerate(bodies, 1)], "doc_id long, title string, body string")


def _search(spark, bodies, queries, **kw):
    q = spark.createDataFrame(queries, "query_id long, q string, k int")
    return [(r.query_id, r.doc_id, r.score) for r in ts.search_text(_corpus(spark, bodies), q, **kw).orderBy("query_id", "rank").collect()]


def test_each_query_has_its_own_limit(spark):
    limits = [None, -3, 0, 5, 25, 50]
    got = _search(spark, ["cat"] * 30, [(i, "cat", k) for i, k in enumerate(limits)])
    assert [sum(q == i for q, _, _ in got) for i in range(6)] == [20, 20, 20, 5, 25, 30]
    vecs = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(30)], "doc_id long, vec array<double>")
    qv = spark.createDataFrame([(i, [1.0, 0.0], k) for i, k in enumerate(limits)], "query_id long, vec array<double>, k int")
    hits = vs.knn(qv, vecs)
    n = {r.query_id: r["count"] for r in hits.groupBy("query_id").count().collect()}
    assert [n[i] for i in range(6)] == [20, 20, 20, 5, 25, 30]
    n = {r.query_id: r["count"] for r in rrf([hits], queries=qv).groupBy("query_id").count().collect()}
    assert [n[i] for i in range(6)] == [20, 20, 20, 5, 25, 30]


def test_negated_clauses_and_phrase_after_stop_word(spark):
    bodies = ["cat x", "dog y", "cow dog", "cow z", ""]
    queries = [(1, "-dog", 20), (2, "cow or -dog", 20), (3, "-dog -cat", 20), (4, '-"cow dog" or -cat', 2), (5, "-dog", 1)]
    assert _search(spark, bodies, queries) == [
        (1, 1, 0.0), (1, 4, 0.0), (1, 5, 0.0), (2, 3, 0.4), (2, 4, 0.4), (2, 1, 0.0), (2, 5, 0.0),
        (3, 4, 0.0), (3, 5, 0.0), (4, 1, 0.0), (4, 2, 0.0), (5, 1, 0.0)]
    q = spark.createDataFrame([(2, "cow or -dog", 1)], "query_id long, q string, k int")
    found = ts.search_text(_corpus(spark, bodies), q, ranked=False)
    assert sorted(r.doc_id for r in found.collect()) == [1, 3, 4, 5]
    assert _search(spark, ["fresh bread"], [(1, 'fresh or "the bread"', 20)], config="english") == [(1, 1, 0.8)]


def test_close_vectors_keep_their_distance(spark):
    a = [1000.0 + i for i in range(8)]
    b = list(a)
    b[0] += 0.007364
    docs = spark.createDataFrame([(1, b), (2, a)], "doc_id long, vec array<double>")
    q = spark.createDataFrame([(1, a)], "query_id long, vec array<double>")
    assert [(r.doc_id, r.score) for r in vs.knn(q, docs, metric="l2").orderBy("rank").collect()] == [(2, 0.0), (1, 0.007364)]
