"""Clauses and cover density by document against plain Python and the windows of ``covers``."""

import random

import pyarrow as pa
from conftest import corpus_df
from sieve.operators import analyze as an
from sieve.operators import textsearch as ts
from sieve.operators.covers import cover_scores
from sieve.operators.pairs import document_pairs

TERMS = ("query_id", "clause_id", "item_id", "negated", "offset", "word", "n_words")


def _query(r, q, words):
    rows, item = [], 0
    for c in range(r.randint(1, 3)):
        for _ in range(r.randint(1, 4)):
            size = r.choice((1, 1, 1, 2, 3))
            neg = r.random() < 0.2
            rows += [(q, c, item, neg, o, r.randrange(words), size) for o in range(size)]
            item += 1
    return rows


def _occurrences(doc, rows):
    """``clause, item, negated, start, end`` and the positions of positive words."""
    at = {p: w for w, p, _ in doc}
    occ, hits = [], set()
    for c, i, neg in {x[1:4] for x in rows}:
        words = [x[5] for x in rows if x[2] == i]
        occ += [(c, i, neg, s, s + len(words) - 1) for s in at if all(at.get(s + o) == w for o, w in enumerate(words))]
        hits |= set() if neg else {p for p, w in at.items() if w in words}
    return occ, hits


def test_matches_windows_and_plain_clauses(spark):
    r = random.Random(5)
    got, want, hit_rows, occ_rows = {}, {}, [], []
    for d in range(60):
        n, words = r.randint(1, 80), r.choice((2, 5, 9))
        doc = [(r.randrange(words), p, 1.0 if p < 3 else 0.4) for p in range(1, n + 1)]
        r.shuffle(doc)
        queries = [_query(r, q, words + (q == 3)) for q in range(6)]
        terms = [x for q in queries for x in q]
        r.shuffle(terms)
        post = pa.table({"doc_id": [d] * n, "word": [x[0] for x in doc], "pos": [x[1] for x in doc], "w": [x[2] for x in doc]})
        table = pa.table({"doc_id": [d] * len(terms), **{c: [x[i] for x in terms] for i, c in enumerate(TERMS)}})
        whole = document_pairs(post, table).to_pylist()
        assert document_pairs(post, table, cells=1).to_pylist() == whole
        got |= {(x["query_id"], d): x for x in whole}
        for q, rows in enumerate(queries):
            occ, hits = _occurrences(doc, rows)
            n_pos = {c: len({x[2] for x in rows if x[1] == c and not x[3]}) for c in {x[1] for x in rows}}
            ok = [c for c, m in sorted(n_pos.items()) if m and len({o[1] for o in occ if o[0] == c and not o[2]}) == m]
            if ok:
                want[q, d] = ok, any(not any(o[0] == c and o[2] for o in occ) for c in ok)
                hit_rows += [(q, d, p, w) for _, p, w in doc if p in hits]
                occ_rows += [(q, d, c, i, s, e, n_pos[c]) for c, i, neg, s, e in occ if not neg]
    assert {k: (x["clauses"], x["matched"]) for k, x in got.items()} == want
    assert any(not m for _, m in want.values()) and any(len(ok) > 1 for ok, _ in want.values())
    h = spark.createDataFrame(hit_rows, "query_id long, doc_id long, pos int, w double")
    o = spark.createDataFrame(occ_rows, "query_id long, doc_id long, clause_id int, item_id int, start int, end int, n_pos int")
    assert {(x.query_id, x.doc_id): round(x.score, 9) for x in cover_scores(h, o).collect()} == {k: round(x["score"], 9) for k, x in got.items()}


def test_hits_are_not_written_by_query(spark, monkeypatch):
    """Many queries of the same words: no written table has more rows than the postings."""
    written, write = [], ts.materialize
    monkeypatch.setattr(ts, "materialize", lambda df, *a: (lambda t: (written.append(t.count()), t)[1])(write(df, *a)))
    c = corpus_df(spark, [("", "red blue green " * 40), ("red", "green blue"), ("", "blue")])
    q = spark.createDataFrame([(i, "red blue green", 5) for i in range(20)], "query_id long, q string, k int")
    got = ts.search_text(c, q, k=5).collect()
    assert sorted((x.query_id, x.doc_id) for x in got) == [(i, d) for i in range(20) for d in (1, 2)]
    assert max(written) <= an.postings(c).count()
