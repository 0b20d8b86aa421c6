"""Stored word index: same answers, only the folders of the words asked for; complements from gaps; outer `or`."""

import random
import re

from pyspark.sql import functions as F

from sieve.operators import textsearch as ts
from sieve.operators import wordindex as wi
from sieve.operators.complement import first_free
from sieve.operators.query_terms import query_terms


def corpus(spark, n=300, seed=2):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["hot"] * 60
    rows = [(7 + 3 * i, r.choice(("", "w1 title", "hot")), " ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, title string, body string")


def asked(spark):
    qs = ["w1 w2", "w3 or w4", '"hot hot"', "w5 -w6", "-hot", "w7 or -w8", "nowhere", "w9 nowhere", "w1", "hot w2 w3 or w1 -hot", " "]
    return spark.createDataFrame([(i, q, 5 + i) for i, q in enumerate(qs)], "query_id long, q string, k int")


def test_stored_search_equals_search(spark, tmp_path):
    c, q = corpus(spark), asked(spark)
    index = wi.write_word_index(c, str(tmp_path / "index"), buckets=8, block_docs=64)
    assert index["postings"].select("block").distinct().count() == 5
    for kw in ({}, {"plain": True}, {"ranked": False}):
        cols = ["query_id", "doc_id"] if kw.get("ranked") is False else ["query_id", "rank", "doc_id", "score"]
        a, b = wi.stored_search(index, q, **kw), ts.search_text(c, q, **kw)
        assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    again = wi.read_word_index(spark, str(tmp_path / "index"))
    assert sorted(map(tuple, wi.stored_phrases(again, q).collect())) == sorted(map(tuple, ts.phrase_matches(ts.build_postings(c), q).collect()))


def test_reads_only_the_words_folders(spark, tmp_path):
    c = corpus(spark).unionByName(spark.createDataFrame([(5, "", "rare"), (9000, "", "rarer")], "doc_id long, title string, body string"))
    index = wi.write_word_index(c, str(tmp_path / "index"), buckets=16, block_docs=64)
    words = spark.createDataFrame([("rare",), ("unseen",)], "term string")
    post, freq = wi.lookup(index, words)
    assert [tuple(r) for r in freq.collect()] == [("rare", 1, 1, 0.4)]
    plan = post._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+[^\]]*block#\d+ = 0", plan), plan
    assert plan.count("FileScan") == 2 and "Generate" not in plan  # the postings and the words asked for
    assert post.count() == 1


def test_directory_counts(spark, tmp_path):
    from sieve.operators.analyze import term_stats
    c = corpus(spark)
    index = wi.write_word_index(c, str(tmp_path / "index"), buckets=4, block_docs=100)
    got = index["terms"].groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, term_stats(ts.build_postings(c)).collect()))
    assert [r.place for r in index["docs"].orderBy("doc_id").collect()] == list(range(1, 301))


def test_empty_corpus(spark, tmp_path):
    index = wi.write_word_index(corpus(spark).limit(0), str(tmp_path / "index"), buckets=4)
    assert wi.stored_search(index, asked(spark)).count() == 0
    assert wi.stored_search(index, asked(spark), ranked=False).count() == 0


def test_first_free_from_gaps(spark):
    r = random.Random(4)
    ids = sorted(r.sample(range(1000), 230))
    docs = spark.createDataFrame([(i + 1, d) for i, d in enumerate(ids)], "place long, doc_id long")
    taken = {0: set(), 1: set(ids), 2: set(ids[:100]), 3: set(ids[1:40]), 4: set(ids) - {ids[-1]}, 5: set(ids[::2]), 6: {ids[0]}, 7: set(ids[:223]), 8: set(ids[30:])}
    taken.update((i, set(r.sample(ids, r.randint(1, 229)))) for i in range(9, 40))
    clauses = spark.createDataFrame([(i,) for i in taken], "clause long")
    excluded = spark.createDataFrame([(c, d) for c, ds in taken.items() for d in ds], "clause long, doc_id long")
    for k, block in ((1, 1), (7, 1), (20, 32), (300, 1 << 16)):
        got = {}
        for x in first_free(clauses, excluded, docs, k, block=block).collect():
            got.setdefault(x.clause, []).append(x.doc_id)
        for c, ds in taken.items():
            assert sorted(got.get(c, [])) == [d for d in ids if d not in ds][:k], (c, k, block)


def test_or_at_the_ends_is_a_word(spark):
    shapes = {"or cat": [["or", "cat"]], "cat or": [["cat", "or"]], "cat OR dog": [["cat"], ["dog"]], "or": [["or"]], "a or or b": [["a"], ["or", "b"]],
              "or or a": [["or"], ["a"]], "a or or or b": [["a"], ["or"], ["b"]], "or or": [["or", "or"]], '"a b" or -or': [["a", "b"], ["or"]], "a or !!": [["a"]]}
    q = spark.createDataFrame(list(enumerate(shapes)), "query_id long, q string")
    got = {}
    for r in query_terms(q).orderBy("query_id", "clause_id", "item_id", "offset").collect():
        got.setdefault(r.query_id, {}).setdefault(r.clause_id, []).append(r.term)
    assert [list(got[i].values()) for i in range(len(shapes))] == list(shapes.values())


def test_first_occurrences_are_marked(spark, tmp_path):
    """df and cf come from the marks of the written postings."""
    from conftest import corpus_df
    from sieve.operators.wordindex import write_word_index
    index = write_word_index(corpus_df(spark, [("red", "red blue red"), ("", "red"), ("", "")]), str(tmp_path / "index"), buckets=2, block_docs=1)
    post = spark.read.parquet(str(tmp_path / "index" / "postings"))
    assert sorted((r.term, r.doc_id, r.pos) for r in post.where("first").collect()) == [("blue", 1, 3), ("red", 1, 1), ("red", 2, 1)]
    found = index["terms"].groupBy("term").agg({"df": "sum", "cf": "sum", "top_w": "max"}).collect()
    assert sorted((r["term"], r["sum(df)"], r["sum(cf)"], r["max(top_w)"]) for r in found) == [("blue", 1, 1, 0.4), ("red", 2, 4, 1.0)]
