"""SimHash components against brute force over all pairs of fingerprints."""

import random
import re

import numpy as np
import xxhash

from sieve.llm.simhash import RADIUS, fingerprint, forest, golay, indices, keys, links_by_key, links_by_word, simhash_components


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def label(fps):
    fps, parent = sorted(set(fps)), {}
    for x in fps:
        parent[x] = x

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= RADIUS:
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in fps}


def brute(rows):
    fp = [plain(t) for _, t in rows]
    of = label(fp)
    least = {}
    for (doc, _), x in zip(rows, fp):
        if doc is not None:
            least[of[x]] = min(least.get(of[x], doc), doc)
    return sorted(((doc, f"{x:016x}", least.get(of[x])) for (doc, _), x in zip(rows, fp)), key=str)


def corpus(seed=4):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "ß", "Wx"]
    texts = [None, "", " \t\n", "one", "One", "two words", "three more words", "a b a b a b a b"]
    for size in (4, 9, 30, 120, 400):
        for _ in range(5):
            base = [r.choice(vocab) for _ in range(size)]
            for edits in (0, 0, 1, 1, 2, 3, 5, 8):
                x = list(base)
                for _ in range(edits):
                    x[r.randrange(size)] = r.choice(vocab)
                texts.append("\x0b ".join(x))
    r.shuffle(texts)
    return [(i * 2, t) for i, t in enumerate(texts)]


def clusters(r, groups, members, flips):
    out = []
    for _ in range(groups):
        x = r.getrandbits(64)
        for _ in range(members):
            y = x
            for _ in range(r.randint(0, flips)):
                y ^= 1 << r.randrange(64)
            out.append(y)
    return out


def got_labels(spark, links, fps):
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        assert (u ^ v).bit_count() <= RADIUS
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in fps}


def test_documents_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, simhash_components(df).collect()), key=str) == brute(rows)


def test_small_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, simhash_components(docs).collect()), key=str) == brute(rows)


def test_links_keep_components(spark):
    """Clusters of fingerprints: by key, by key with tiny groups, and by words alone."""
    r = random.Random(8)
    fps = sorted(set(clusters(r, 60, 12, 4) + clusters(r, 2, 150, 3) + clusters(r, 1, 40, 12)))
    want = label(fps)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    plus = lambda x: x % (1 << 64)
    for group in (16_384, 20, 1):
        rows = links_by_key(nodes, group).collect()
        links = [(plus(x.u), plus(x.v)) for x in rows if x.v is not None]
        large = {x.u for x in rows if x.v is None}
        assert bool(large) == (group < 100)
        if large:
            links += [(plus(x.u), plus(x.v)) for x in links_by_word(nodes.filter(nodes.fp.isin(large))).collect()]
        assert got_labels(spark, links, fps) == want
    assert got_labels(spark, [(plus(x.u), plus(x.v)) for x in links_by_word(nodes).collect()], fps) == want


def test_near_fingerprints_share_a_key():
    r = random.Random(2)
    for _ in range(3000):
        x = r.getrandbits(64)
        y = x
        for _ in range(r.randint(1, 3)):
            y ^= 1 << r.randrange(64)
        key, at = keys(np.array([x, y], np.uint64))
        assert np.intersect1d(key[at == 0], key[at == 1]).size
        assert len(key) <= 2 * 77 and len(np.unique(key[at == 0])) == (at == 0).sum()


def test_golay_tables():
    """The code is perfect, and neighbours' own indices are among each other's keys."""
    _, error, change = golay()
    assert (change[:, 0] == 0).all() and (np.bitwise_count(error) <= 3).all()
    assert set((change >= 0).sum(axis=1)) == {1, 6}
    words = np.random.default_rng(1).integers(0, 1 << 23, 400)
    for bit in range(23):
        a, b = indices(words), indices(words ^ (1 << bit))
        assert ((a[:, :1] == b).any(axis=1) & (b[:, :1] == a).any(axis=1)).all()


def test_fingerprint_in_blocks():
    r = random.Random(6)
    for size in (0, 1, 2, 3, 4, 50, 700):
        text = "  ".join(r.choice(("Ab", "c", "dé", "longer-word")) for _ in range(size)) + "\r\n"
        assert {fingerprint(text.encode(), block=b) for b in (1, 7, 64, 1 << 20)} == {plain(text)}
    assert fingerprint(None) == 0 == plain(None)


def test_forest_spans():
    r = random.Random(3)
    fps = sorted(set(clusters(r, 3, 200, 4)))
    u, v = forest(np.array(fps, np.uint64))
    want = label(fps)
    assert len(u) == len(fps) - len(set(want.values()))
    assert got_labels(None, zip(u.tolist(), v.tolist()), fps) == want


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, fp string, label int")
    assert simhash_components(empty).collect() == []
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r"), (3, None), (9, "  "), (1, "word " * 300_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, least int, u string")
    assert sorted(map(tuple, simhash_components(df).collect()), key=str) == brute(rows)
