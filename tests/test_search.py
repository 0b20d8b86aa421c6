"""Retrieval fixtures: text (cover density), overlap, vector, hybrid."""

from conftest import corpus_df, queries_df
from sieve.operators import embedding as emb
from sieve.operators import fuzzy as fz
from sieve.operators import hybrid as hy
from sieve.operators import textsearch as ts
from sieve.operators import vectorsearch as vs

T = [("Postgres Indexing", "B-tree, GIN, GiST, BRIN"), ("Baking Bread", "flour, yeast, water, salt"),
     ("Trip to Japan", "Tokyo, Kyoto, Osaka")]
T4 = T + [("Hobby cooking", "postgres is great too")]
V = [("Postgres Indexing Basics", "btree gin gist brin"), ("Bread Recipes", "flour yeast water"),
     ("Travel in Japan", "tokyo kyoto osaka")]
H = [("Postgres Indexing", "btree gin gist"), ("Vector Search", "pgvector similarity"),
     ("Baking Bread", "flour yeast water")]
P = [("Postgres Indexing Basics", "btree and gin indexes power most production workloads", ["postgres"]),
     ("Baking Bread at Home", "flour yeast water salt and time", ["food"])]


def _scores(df):
    return {(r.query_id, r.doc_id): round(r.score, 6) for r in df.collect()}


def test_cover_density_fixtures(spark):
    got = _scores(ts.search_text(corpus_df(spark, T), queries_df(spark, ["postgres"])))
    assert got == {(1, 1): 1.0}
    got = _scores(ts.search_text(corpus_df(spark, T4), queries_df(spark, ["postgres"])))
    assert got == {(1, 1): 1.0, (1, 4): 0.4}
    got = _scores(ts.search_text(corpus_df(spark, P), queries_df(spark, ["postgres indexing"])))
    assert got == {(1, 1): 1.0}


def test_cover_density_hand_cases(spark):
    # body-only AND with one word between: 'gin'(6,B) 'power'(8,B) -> 2/(2.5+2.5)/(1+1)
    c = corpus_df(spark, P)
    got = _scores(ts.search_text(c, queries_df(spark, ["gin power"])))
    assert got == {(1, 1): round(2 / 5 / 2, 6)}
    # OR: each occurrence is its own cover; phrase and negation
    got = _scores(ts.search_text(c, queries_df(spark, ["flour or btree", '"yeast water"', "salt -btree"])))
    assert got[(1, 1)] == 0.4 and got[(1, 2)] == 0.4
    assert got[(2, 2)] == round(2 / 5, 6)
    assert (3, 1) not in got and got[(3, 2)] == 0.4


def test_blank_queries_return_nothing(spark):
    c = corpus_df(spark, H)
    q = queries_df(spark, ["", "   ", "\t\n"])
    assert ts.search_text(c, q).count() == 0
    assert fz.overlap_search(c, q).count() == 0
    from pyspark.sql import functions as F

    from sieve.functions.text import is_blank
    assert q.where(~is_blank(F.col("q"))).count() == 0


def test_overlap_fixtures(spark):
    got = _scores(fz.overlap_search(corpus_df(spark, H), queries_df(spark, ["postgres", "postgres indexing"])))
    assert got == {(1, 1): 1.5, (2, 1): 3.0}
    got = _scores(fz.overlap_search(corpus_df(spark, T4), queries_df(spark, ["postgres"])))
    assert got == {(1, 1): 1.5, (1, 4): 1.0}


def test_vector_fixtures(spark):
    c = corpus_df(spark, H)
    qv = emb.embed_queries(queries_df(spark, ["postgres", "postgres indexing"]))
    got = _scores(vs.knn(qv, emb.embed_corpus(c), k=20))
    assert got == {(1, 1): 0.408248, (1, 2): 0.0, (1, 3): 0.0, (2, 1): 0.612372, (2, 2): 0.0, (2, 3): 0.0}
    cv = corpus_df(spark, V)
    got = _scores(vs.knn(emb.embed_queries(queries_df(spark, ["postgres indexing"])), emb.embed_corpus(cv)))
    assert got[(1, 1)] == 0.668648 and got[(1, 2)] == 0.0
    ranks = [r.doc_id for r in vs.knn(qv, emb.embed_corpus(c)).where("query_id = 1").orderBy("rank").collect()]
    assert ranks == [1, 2, 3]  # ties by id; zero scores kept


def test_hybrid_fixture_and_invariants(spark):
    c = corpus_df(spark, H)
    q = queries_df(spark, ["postgres", "postgres indexing"])
    text = ts.search_text(c, q)
    vec = vs.knn(emb.embed_queries(q), emb.embed_corpus(c))
    b = hy.blend(text, vec)
    got = _scores(b)
    assert got == {(1, 1): 1.0, (1, 2): 0.0, (1, 3): 0.0, (2, 1): 1.0, (2, 2): 0.0, (2, 3): 0.0}
    rows = b.orderBy("query_id", "rank").collect()
    for qid in (1, 2):
        s = [r.score for r in rows if r.query_id == qid]
        assert s == sorted(s, reverse=True)
        ids = [r.doc_id for r in rows if r.query_id == qid]
        assert len(ids) == len(set(ids))
    for r in hy.rrf([text, vec]).collect():
        assert 0 < r.score <= 2 / 61 + 1e-6  # scores are rounded to 6 places


def test_alternatives_of_single_words_need_no_hits(spark, monkeypatch):
    """`word`, `a or b`, `a or -b`: the weights of the words are summed, without positions by query."""
    asked = []
    match = ts.match_hits
    monkeypatch.setattr(ts, "match_hits", lambda post, qt, *a, **k: (asked.append(qt.count()), match(post, qt, *a, **k))[1])
    c = corpus_df(spark, [("red", "red blue"), ("", "blue blue green"), ("", "other"), ("blue", "")])
    q = queries_df(spark, ["red", "red or blue", "red or -blue", "blue or blue"])
    got = {}
    for r in ts.search_text(c, q).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    assert {i: sorted(v) for i, v in got.items()} == {
        1: [(1, 1, 1.4)],
        2: [(1, 1, 1.8), (2, 4, 1.0), (3, 2, 0.8)],
        3: [(1, 1, 1.4), (2, 3, 0.0)],
        4: [(1, 4, 1.0), (2, 2, 0.8), (3, 1, 0.4)]}
    pairs = ts.search_text(c, q, ranked=False).collect()
    assert sorted((r.query_id, r.doc_id) for r in pairs) == sorted((i, d) for i, v in got.items() for _, d, _ in v)
    assert asked == [0, 0]
