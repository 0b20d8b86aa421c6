"""Prefix trie against brute force over whole turn tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

from sieve.llm.prefix_trie import prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuild(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuild(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for p, cs in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        kids = [q for q in sub if len(q) == len(p) + 1]
        leaf = lambda q: not any(r[:len(q)] == q and len(r) > len(q) for r in members)
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids), sum(map(leaf, sub)),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in sub if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, prefix_trie(*rebuilt(df)).collect()), key=str)


def conversations(seed, n=140, texts=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-120, 420), n):
        for t in range(r.choice((1, 1, 2, 3, 5, 8, 12))):
            rows.append((c, r.choice((t, t, t, None)), r.choice(("user", "assistant", None)),
                         r.choice((None, "", "é" * 3, "two words", "x" * 40)[:texts + 2])))
    rows += rows[:9] + [(None, 1, "user", "no conversation")] * 3
    r.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    for seed, texts in ((1, 1), (2, 3)):
        rows = conversations(seed, texts=texts)
        assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_equal_and_nested_conversations(spark):
    """Every prefix of a long conversation is a conversation too, and one is repeated more often than a piece holds."""
    rows = [(100 * k, t, "user", f"turn {t}") for k in range(1, 14) for t in range(k)]
    rows += [(5000 + 100 * k, 1, "user", "same") for k in range(700)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_long_runs_take_one_round(spark):
    """Two conversations of 400 equal turns that part at the end."""
    rows = [(c, t, "user", f"turn {t}" if t < 399 else f"end {c}") for c in (1000, 2000, 3000) for t in range(400)]
    nodes = prefix_trie(*rebuilt(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, nodes.collect()), key=str) == brute(rows)
    assert nodes.count() == 403


def test_edges(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []
    rows = [(7, 0, "user", "a"), (7, 0, "user", "a"), (7, None, None, None), (300, 2, "", ""), (301, 1, "z", "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "b", 0) for r in rows], SCHEMA + ", depth int, a string, n int")
    assert got(df) == brute(rows)
