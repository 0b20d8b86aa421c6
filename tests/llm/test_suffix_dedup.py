"""Repeated 100-byte strings against brute force over all starts."""

import hashlib
import random

import numpy as np

from sieve.llm.suffix_dedup import entries, remove_repeats, string_hashes


def brute(rows, length=100):
    """Rows ``(id, text)`` in order; equal rows are one document."""
    seen, out, done = {}, [], {}
    for d, t in rows:
        if (d, t) in done:
            out.append(done[d, t])
            continue
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            x = raw[s:s + length]
            if x in seen:
                gone[s:s + length] = True
            else:
                seen[x] = 1
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        done[d, t] = (d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        out.append(done[d, t])
    return sorted(out, key=str)


def corpus():
    r = random.Random(9)
    word = lambda: "".join(r.choice(("th", "er", "é", "ing", "a")) for _ in range(r.randrange(1, 4)))
    say = lambda n: " ".join(word() for _ in range(n))
    passages, rows = [say(n) for n in (30, 40, 80, 25)], []
    base = say(200)
    for i in range(120):
        kind = i % 6
        if kind == 0:
            t = say(r.randrange(0, 120))
        elif kind == 1:
            t = say(5) + r.choice(passages) + say(30)
        elif kind == 2:
            k = r.randrange(len(base) - 40)
            t = base[:k] + "X" + base[k + r.randrange(2):]
        elif kind == 3:
            p = r.choice(passages)
            t = p[r.randrange(60):] + r.choice(passages) + p
        elif kind == 4:
            t = ("ab" * 120 + "c") * r.randrange(1, 3) + "x" * r.randrange(90, 300)
        else:
            t = rows[r.randrange(len(rows))][1]
        rows.append((i * 2, t))
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 60
    for batches in (1, 2, 5):
        assert sorted(map(tuple, remove_repeats(df, batches=batches).collect()), key=str) == want


def test_small_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(map(tuple, remove_repeats(docs).collect()), key=str) == brute(rows)


def test_anchors_cover_every_string_once():
    r = np.random.default_rng(1)
    b = r.integers(97, 100, 3000).astype(np.uint8)
    with np.errstate(over="ignore"):
        key, ctx, start, n, off = entries(b, 100)
        assert start.tolist() == [0, *np.cumsum(n)[:-1].tolist()] and n.sum() == 2901 and n.max() <= 69 and off.max() <= 68
        grams, strings = string_hashes(b, 100)
        assert len(grams) == 2969 and len(strings) == 2901
        moved = entries(np.concatenate((b[:7], b)), 100)  # the same text further on has the same entries
        assert set(ctx[2:].tolist()) <= set(moved[1].tolist())


def test_edges(spark):
    a = "0123456789" * 8 + "abcdefghijklmnopqrst" + "uvw"
    rows = [(None, a), (1, None), (2, ""), (3, a[:99]), (4, a), (4, a), (4, "z" + a), (5, a[3:] + "z" * 1_200_000), (6, "y" + "z" * 700)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, doc int")
    from pyspark.sql import functions as F
    marks = {r.text: r.m for r in df.select("text", F.xxhash64("text").alias("m")).collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, marks[x[1]] if x[0] == 4 else 0))
    assert sorted(map(tuple, remove_repeats(df, batches=2).collect()), key=str) == brute(order)
    assert remove_repeats(df.limit(0)).count() == 0


def test_many_texts_under_one_id(spark):
    """More than 1,024 different texts under one id, a null one too, are documents of their own."""
    from pyspark.sql import functions as F
    r = random.Random(2)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared = say(180)
    rows = [(d, f"{i} " + (say(150) if i % 3 else say(40) + shared[i % 50:] + say(30))) for d in (None, 4) for i in range(1_100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = {x.text: x.m for x in df.select("text", F.xxhash64("text").alias("m")).collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, marks[x[1]]))
    assert sorted(map(tuple, remove_repeats(df, batches=2).collect()), key=str) == brute(order)
