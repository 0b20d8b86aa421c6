"""q-gram lemma filter against full dynamic programming."""

import random

import numpy as np

from sieve.llm.decontaminate import Index, decontaminated, grams, leaks, normalise, within_edits


def distance(text, w):
    """Least edits between ``w`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(w, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def norm(t):
    return "".join(map(chr, normalise(t)))


def edited(r, s, n):
    for _ in range(n):
        i = r.randrange(len(s))
        s = r.choice([s[:i] + s[i + 1:], s[:i] + r.choice("abcé ") + s[i:], s[:i] + r.choice("xyz") + s[i + 1:]])
    return s


def sentence(r, n):
    return " ".join("".join(r.choice(("th", "er", "on", "an", "ing", "é")) for _ in range(r.randrange(1, 4))) for _ in range(n))


def fixture():
    r = random.Random(4)
    items = [(i, sentence(r, n)) for i, n in enumerate((3, 7, 9, 14, 25, 40, 60, 12))]
    docs = []
    for k in range(90):
        body = sentence(r, r.randrange(0, 80))
        if k % 3:
            item = items[r.randrange(len(items))][1]
            lo = r.randrange(0, max(1, len(item) // 3))
            body += " " + edited(r, item[lo:], r.randrange(0, 9)).upper() + "... " + sentence(r, r.randrange(0, 30))
        docs.append((k, body))
    return items, docs


def test_matches_brute_force(spark):
    items, docs = fixture()
    index = Index(items)
    want = set()
    for k, t in docs:
        text = norm(t)
        for item, w, e, _ in index.windows:
            if distance(text, "".join(map(chr, w))) <= e:
                want.add((k, item))
    assert want and {k for k, _ in want} != {k for k, _ in docs}
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = leaks(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert {(r.doc_id, r.item_id) for r in leaks(d, b, block_chars=300).collect()} == want
    assert {r.doc_id for r in decontaminated(d, b).collect()} == {k for k, _ in docs} - {k for k, _ in want}


def test_exact_passages_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    items = bench.collect()
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in d.text}
    assert len(want) > 20 and want <= got


def test_grams_and_alignment():
    a = normalise("abc abc abd abcabc")
    for q in (1, 3, 5, 8, 12):
        h = grams(a, q)
        s = [tuple(a[i:i + q]) for i in range(len(a) - q + 1)]
        assert len(h) == len(s) and all((h[i] == h[j]) == (s[i] == s[j]) for i in range(len(s)) for j in range(len(s)))
    assert len(grams(a[:2], 5)) == 0
    r = random.Random(1)
    for _ in range(60):
        w = "".join(r.choice("abcd") for _ in range(24))
        t = "".join(r.choice("abcd") for _ in range(10)) + edited(r, w, r.randrange(0, 4)) + "dd"
        d = distance(t, w)
        got = within_edits(normalise(t), normalise(w), -8, 40, 6)
        assert (got is None and d > 6) or got[0] == d


def test_edges(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    b = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "The.")], "item_id long, text string")
    rows = [(1, None, 0), (2, "", 0), (3, "THE QUICK, brown fox; jumps over the lazy dog near the river bank!", 1),
            (3, "THE QUICK, brown fox; jumps over the lazy dog near the river bank!", 1), (None, "x " * 50_000 + item, 2), (5, "the.", 3)]
    d = spark.createDataFrame(rows, "doc_id long, text string, item_id long")
    got = sorted(((r.doc_id, r.item_id) for r in leaks(d, b).collect()), key=str)
    assert got == sorted([(3, 1), (3, 2), (3, 1), (3, 2), (None, 1), (None, 2)], key=str)
    assert sorted(r.doc_id for r in decontaminated(d, b).collect()) == [1, 2, 5]
    assert leaks(d.limit(0), b).count() == 0 and leaks(d, b.limit(0)).count() == 0
    assert np.array_equal(normalise(" A--b  "), normalise("-a b"))


def test_passages_and_short_items(spark):
    """Every run of 60 characters of an item is found wherever it lies, and items under 32 characters as a whole."""
    r = random.Random(11)
    say = lambda n: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate((13, 20, 40, 70))] + [(9, "blue heron 41 lake")]
    docs, want = [], set()
    for i, t in items[:-1]:
        for lo in (x for x in range(len(t) - 60 + 1) if t[x] != " " and t[x + 59] != " "):
            docs.append((len(docs), say(8) + " " + t[lo:lo + 60] + " " + say(8)))
            want.add((len(docs) - 1, i))
    docs += [(-1, say(30)), (-2, "a Blue heron, 41 lake b"), (-3, "a blue heron 42 lake b")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in leaks(d, b).collect()} == want | {(-2, 9)}
