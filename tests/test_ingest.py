"""Ingest invariants: ids, cleaning order, lookups, IVF exactness."""

import pytest
from pyspark.sql import functions as F

from conftest import corpus_df, queries_df
from sieve.operators import embedding as emb
from sieve.operators import ingest as ing
from sieve.operators import ivf
from sieve.operators import vectorsearch as vs


def test_assign_ids_consecutive(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    ids = ing.assign_ids(df, ["k"]).orderBy("k").collect()
    assert [r.id for r in ids] == list(range(1, 1001))


def test_clean_corpus_first_category_wins_then_filters(spark):
    long = "x" * 130
    rows = [(1, "A", long, "cat_one", 0, 1), (2, "A", long, "cat_two", 1, 1),
            (3, "B", "short", "cat_one", 0, 2), (4, "B", long, "cat_two", 1, 2),
            (5, "C", long, "cat_one", 0, 3)]
    rec = spark.createDataFrame(rows, "doc_id long, title string, body string, category string, "
                                      "category_order int, listing_order long")
    got = {(r.doc_id, r.tag) for r in ing.clean_corpus(rec, cap=2).collect()}
    # cap 2 drops doc 5; title B's first (doc 3) is too short and is not retried in cat_two
    assert got == {(1, "cat one")}


def test_lookup_misses_are_null(spark):
    c = corpus_df(spark, [("a", "b"), ("c", "d")])
    ids = spark.createDataFrame([(1,), (9,)], "doc_id long")
    got = {r.doc_id: r.title for r in ing.lookup_ids(c, ids).collect()}
    assert got == {1: "a", 9: None}


def test_ivf_all_lists_equals_exact(spark):
    docs = [(f"t{i}", " ".join(f"w{(i * j) % 37}" for j in range(12))) for i in range(60)]
    c = corpus_df(spark, docs)
    vecs = emb.embed_corpus(c)
    qv = emb.embed_queries(queries_df(spark, ["w1 w2 w3", "w5 w8", "w30"]))
    cents, assigned = ivf.build_ivf(vecs, lists=6)
    a = {(r.query_id, r.rank, r.doc_id) for r in ivf.ivf_search(qv, cents, assigned, k=5, nprobe=6).collect()}
    e = {(r.query_id, r.rank, r.doc_id) for r in vs.knn(qv, vecs, k=5, k_col=None).collect()}
    assert a == e
    rec = ivf.recall_at_k(ivf.ivf_search(qv, cents, assigned, k=5, nprobe=1), vs.knn(qv, vecs, k=5, k_col=None), 5)
    for r in rec.collect():
        assert 0.0 <= r.recall <= 1.0


def test_write_postings_layout(spark, tmp_path):
    from sieve.operators import analyze as an
    c = corpus_df(spark, [("alpha beta", "beta gamma beta"), ("beta", "delta")])
    path = str(tmp_path / "post")
    an.write_postings(an.postings(c), path, buckets=4)
    back = spark.read.parquet(path)
    assert back.count() == 7
    assert back.where("term = 'beta'").count() == 4


def test_jsonl_limit_blank_and_bad_lines(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"title": "b", "body": "two", "tags": ["x"]}\n\n{"title": "a"}\n   \n{"title": "c", "extra": 1}\n')
    assert sorted(r.title for r in ing.read_jsonl(spark, str(path)).collect()) == ["a", "b", "c"]
    assert [r.title for r in ing.read_jsonl(spark, str(path), limit=2, order_by=["title"]).collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        ing.read_jsonl(spark, str(path), limit=2)
    path.write_text('{"title": "a"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        ing.read_jsonl(spark, str(path)).collect()


def test_defaults_for_missing_fields(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, "t", "b", ["x"])], "doc_id long, title string, body string, tags array<string>")
    assert sorted(map(tuple, ing.with_defaults(df).collect())) == [(1, "", "", []), (2, "t", "b", ["x"])]
    assert [r.tags for r in ing.with_defaults(df.drop("tags")).collect()] == [[], []]


def test_replace_shows_old_or_new_never_a_mixture(spark, tmp_path):
    root = str(tmp_path / "index")
    assert ing.read_current(spark, root) is None
    old = ing.replace_index(corpus_df(spark, [("a", "x"), ("b", "y")]), root)
    broken = corpus_df(spark, [("c", "z")]).withColumn("body", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        ing.replace_index(broken, root)
    assert sorted(r.title for r in ing.read_current(spark, root)["corpus"].collect()) == ["a", "b"]
    new = ing.replace_index(corpus_df(spark, [("d", "w w")]), root)
    assert [r.title for r in new["corpus"].collect()] == ["d"] and new["postings"].count() == 3
    assert old["corpus"].count() == 2 and old["vectors"].count() == 2
    assert [r.title for r in ing.read_current(spark, root)["corpus"].collect()] == ["d"]


def test_shaped_hits_carry_document_and_details(spark):
    from sieve.operators.hybrid import shape_hits
    c = corpus_df(spark, [("a", "x" * 500), ("b", None)])
    hits = spark.createDataFrame([(1, 1, 2, 0.12345678, 0.5), (1, 2, 1, 0.0, None), (1, 3, 9, 0.0, None)],
                                 "query_id long, rank int, doc_id long, score double, text_raw double")
    got = {r.doc_id: r for r in shape_hits(hits, c).collect()}
    assert sorted(got) == [1, 2] and len(got[1].body) == 500
    assert got[2].score == 0.123457 and got[2].details.text_raw == 0.5
    assert "details" not in shape_hits(hits.drop("text_raw"), c).columns
