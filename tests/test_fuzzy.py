"""Substring and trigram operators against brute force on small tables."""

import re

from sieve.operators import fuzzy as fz

TITLES = ["Postgres Indexing", "", None, "a", "Ab ab", "banana Bread", "x\U0001F600y", "50% off_now", "ananas", "ananas",
          "zz " + "long" * 400]
BODIES = ["b-tree gin", "postgres is great", "ab", None, "", "one　two", "smile \U0001F600", "an_a%", "nana", "nana", "q"]


def corpus(spark):
    rows = [(i, t, b, "extra") for i, (t, b) in enumerate(zip(TITLES, BODIES))]
    return spark.createDataFrame(rows, "doc_id long, title string, body string, s string")


def queries(spark, texts, k=None):
    return spark.createDataFrame([(i, t, k) for i, t in enumerate(texts)], "query_id long, q string, k int")


def test_ilike_equals_brute_force(spark):
    pats = ["", None, "A", "an", "ana", "anan", "POSTGRES", "%", "_", "zz long", "\U0001F600", "x\U0001F600y", "nothing", "an", "longlonglong"]
    p = spark.createDataFrame([(i, s, 1) for i, s in enumerate(pats)], "query_id long, pattern string, sid int")
    got = sorted(map(tuple, fz.ilike_matches(corpus(spark), p).collect()))
    assert got == sorted((i, d) for i, s in enumerate(pats) for d, t in enumerate(TITLES)
                         if (s or "").lower() in (t or "").lower())
    assert fz.ilike_matches(corpus(spark), p.limit(0)).count() == 0
    assert fz.ilike_matches(corpus(spark).limit(0), p).count() == 0


def test_overlap_equals_brute_force_with_unicode_blanks(spark):
    texts = ["ana a post", "one two one", "　", None, "two AB", "\U0001F600", "%"]
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in fz.overlap_search(corpus(spark), queries(spark, texts)).collect()}
    want = {}
    for i, t in enumerate(texts):
        for d, (title, body) in enumerate(zip(TITLES, BODIES)):
            title, body = (title or "").lower(), (body or "").lower()
            s = sum(1.5 if x in title else 1.0 for x in re.split(r"\s+", (t or "").lower()) if x and x in f"{title} {body}")
            if s:
                want[i, d] = s
    assert got == want
    assert [r["doc_id"] for r in fz.overlap_search(corpus(spark), queries(spark, ["ana"], k=2)).orderBy("rank").collect()] == [5, 8]


def _grams(s):
    return {f"  {w} "[i:i + 3] for w in re.findall(r"[^\W_]+", (s or "").lower()) for i in range(len(w) + 1)}


def _similar(q, t):
    a, b = _grams(q), _grams(t)
    return len(a & b) / len(a | b) if a & b else 0


def test_fuzzy_titles_equal_brute_force_in_small_tiles(spark, monkeypatch):
    texts = ["ananas bread", "postgre", "", "long", "ab", "ananas"]
    want = {(i, d): round(_similar(q, t), 6) for i, q in enumerate(texts) for d, t in enumerate(TITLES) if _similar(q, t) >= 0.1}
    c = corpus(spark).coalesce(1)
    got = fz.fuzzy_title(c, queries(spark, texts), 0.1)
    assert {(r["query_id"], r["doc_id"]): r["similarity"] for r in got.collect()} == want
    monkeypatch.setattr(fz, "QUERY_BLOCK_BYTES", 200)
    top = fz.fuzzy_title(c, queries(spark, texts), 0.1, k=2)
    best = [(i, r + 1, d) for i in range(len(texts))
            for r, d in enumerate(sorted((d for q, d in want if q == i), key=lambda d: (-want[i, d], d))[:2])]
    assert sorted((r["query_id"], r["rank"], r["doc_id"]) for r in top.collect()) == best
    assert fz.fuzzy_title(c.limit(0), queries(spark, texts), 0.1, k=2).count() == 0
    assert fz.fuzzy_title(c, queries(spark, [" "]), 0.1).count() == 0


def test_tiles_and_running_limit_keep_every_best_title():
    import numpy as np
    import pyarrow as pa

    from types import SimpleNamespace
    rng = np.random.default_rng(3)
    alphabet = [chr(97 + i) * 3 for i in range(12)]
    sets = [list(rng.choice(alphabet, rng.integers(1, 9), replace=False)) for _ in range(120)]
    qs = [{"id": 7 * i, "grams": s} for i, s in enumerate(sets[:9])]
    batches = [pa.RecordBatch.from_pydict({"id": pa.array(range(lo, lo + 40), pa.int64()),
                                           "grams": pa.array(sets[lo:lo + 40], pa.list_(pa.string()))}) for lo in (0, 40, 80)]
    old = fz._CELLS, fz._PIECE
    fz._CELLS, fz._PIECE = 40, 5
    try:
        got = [r for b in fz._scan_counter(SimpleNamespace(value=fz._lists_of([q["id"] for q in qs], [q["grams"] for q in qs])), 200, 3)(batches) for r in b.to_pylist()]
    finally:
        fz._CELLS, fz._PIECE = old
    want = []
    for q in qs:
        hits = []
        for d, s in enumerate(sets):
            both = len(set(s) & set(q["grams"]))
            either = len(set(s) | set(q["grams"]))
            if both and both * 1000 >= either * 200:
                hits.append((-((2_000_000 * both + either) // (2 * either)), d))
        want += [(q["id"], d, -key) for key, d in sorted(hits)[:3]]
    assert sorted((r["query_id"], r["doc_id"], r["key"]) for r in got) == sorted(want)
