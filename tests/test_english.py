"""English configuration (stop words keep positions, Snowball stems)."""

from conftest import corpus_df, queries_df
from sieve.operators import analyze as an
from sieve.operators import textsearch as ts
from sieve.operators.stem import STOP_WORDS, stem

P = [("Postgres Indexing Basics", "btree and gin indexes power most production workloads", ["postgres"]),
     ("Baking Bread at Home", "flour yeast water salt and time", ["food"])]


def test_stated_stems():
    assert stem("postgres") == "postgr"
    assert {stem(w) for w in ("indexing", "indexes", "indexed")} == {"index"}
    assert stem("basics") == "basic"
    assert len(STOP_WORDS) == 127


def test_english_postings_positions(spark):
    p = an.postings(corpus_df(spark, P), config="english").where("doc_id = 1")
    got = sorted((r.pos, r.term, r.weight) for r in p.collect())
    assert got[:3] == [(1, "postgr", "A"), (2, "index", "A"), (3, "basic", "A")]
    assert (5, "and", "B") not in got and (6, "gin", "B") in got and (7, "index", "B") in got


def test_english_cover_density_fixture(spark):
    c = corpus_df(spark, P)
    got = {(r.query_id, r.doc_id): round(r.score, 6)
           for r in ts.search_text(c, queries_df(spark, ["postgres indexing", "the bread"]),
                                   config="english").collect()}
    assert got == {(1, 1): 1.0, (2, 2): 1.0}
