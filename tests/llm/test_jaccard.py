"""Parity-sketch join against brute force over exact shingle strings."""

import random
import re
from collections import defaultdict

import numpy as np

from sieve.llm.components import components
from sieve.llm.jaccard import Scheme, jaccard_components, shingles, WordHash


def brute(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(rows[i][0])
    return sorted((rows[i][0], len(sets[i]), min(least[find(i)])) for i in range(len(rows)))


def corpus(seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for size in (1, 2, 3, 5, 8, 13, 20, 40, 90, 200, 500):
        for _ in range(4):
            base = [r.choice(vocab) for _ in range(size)]
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, 3, 5, 9):
                x = list(base)
                for _ in range(edits):
                    x[r.randrange(len(x))] = r.choice(vocab)
                texts.append("  ".join(x) + "\n")
            texts.append(" ".join(base + base[: max(1, size // 9)]))
    texts += [None, "", " \t\n", "A b C d e", "a B c D E", "x y z"]
    r.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def test_components_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, num in ((4, 85), (2, 50)):
        got = sorted(map(tuple, jaccard_components(df, n, num, 100).collect()))
        assert got == brute(rows, n, num, 100)


def test_chain_of_near_copies(spark):
    """Neighbours in a chain link, its ends don't; later rounds must find the links."""
    words = [f"a{i}" for i in range(300)]
    rows, x = [], list(words)
    for i in range(60):
        rows.append((100 - i, " ".join(x)))
        x[(i * 37) % 300] = f"b{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, jaccard_components(df, 4, 85, 100).collect()))
    assert got == brute(sorted(rows), 4, 85, 100)


def test_small_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, jaccard_components(docs, 4, 85, 100).collect()))
    assert got == brute(sorted(rows), 4, 85, 100)


def test_pigeonhole_bound():
    """Sets within the bound always share a key."""
    r, scheme = np.random.default_rng(5), Scheme(85, 100)
    for _ in range(300):
        size = int(r.integers(1, 700))
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        common = a[r.random(len(a)) > r.random() * 0.2]
        b = np.unique(np.concatenate((common, r.integers(0, 1 << 63, int(r.integers(0, 1 + size // 9)), dtype=np.uint64))))
        inter = len(np.intersect1d(a, b))
        if len(b) and 100 * inter >= 85 * (len(a) + len(b) - inter) and inter < max(len(a), len(b)):
            assert len(np.intersect1d(scheme.keys(a), scheme.keys(b)))


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, node string")
    assert jaccard_components(empty).collect() == []
    rep = spark.createDataFrame([(1, "a b c d e f", 5), (1, "a b c d e f", 5), (2, None, 1), (None, "a b c d e f", 2),
                                 (7, "q r s t u v", 0), (7, "k l m n o p", 0)], "doc_id long, text string, key long")
    got = sorted(map(tuple, jaccard_components(rep, 4, 85, 100).collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 0, 2), (None, 3, 1), (7, 3, 7), (7, 3, 7)], key=str)
    long_text = " ".join(f"w{i % 5000}x{i}" for i in range(40_000))
    big = spark.createDataFrame([(1, long_text), (2, long_text + " end"), (3, "end")], "doc_id long, text string")
    assert sorted(r.component_id for r in jaccard_components(big).collect()) == [1, 1, 3]


def test_null_ids_link(spark):
    """Near copies under a null id get the smallest id of their component, and join what links only through them."""
    words = [f"u{i}" for i in range(200)]
    step = lambda k: " ".join([f"x{i}" for i in range(k)] + words[k:])
    rows = [(5, step(0)), (None, step(4)), (3, step(8)), (None, step(4)), (None, "p q r s t u v w x y z"),
            (8, "alone in the world with these words"), (8, "another text under an id that comes twice")]
    assert [c for _, _, c in brute([(1, step(0)), (2, step(8))], 4, 93, 100)] == [1, 2]  # neighbours link, ends don't
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_components(df, 4, 93, 100).collect()), key=str)
    assert got == sorted([(5, 197, 3), (None, 197, 3), (3, 197, 3), (None, 197, 3), (None, 8, None), (8, 4, 8), (8, 5, 8)], key=str)


def test_components_helper(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500)]
    got = {x.node: x.label for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for u, v in edges:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    assert got == label


def test_shingles_rule():
    w = WordHash()
    assert len(shingles("A b c D", 4, w)) == 1
    assert np.array_equal(shingles("Aa BB cc dd", 4, w), shingles("aa bb\tCC\x0bdd ", 4, w))
    assert not np.array_equal(shingles("É b c d", 4, w), shingles("é b c d", 4, w))
    assert len(shingles("a b a b a b a b", 2, w)) == 2


def test_sketches_tell_large_sets_apart(spark):
    """Unrelated sets of any size fail the sketch test, linked ones never do, across the sizes at which sketches grow."""
    from pyspark.sql import functions as F

    from sieve.llm.jaccard import near_by_sketch, signatures
    r = random.Random(9)
    rows, related = [], set()
    for size in (40, 900, 1020, 1100, 2040, 2100, 5000):
        for k in range(4):
            words = [f"{size}x{k}x{r.randrange(10 ** 9)}" for _ in range(size)]
            near = words + [f"new{i}" for i in range(size // 20)]
            related.add((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(near))]
    nodes = signatures(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    assert {len(x.sketch) * 64 for x in nodes.collect()} == {1024, 2048, 4096, 8192}
    of = {x.node: x.doc_id for x in nodes.collect()}
    pairs = spark.createDataFrame([(a, b) for a in of for b in of if of[a] < of[b]], "a long, b long")
    got = {(of[x.a], of[x.b]) for x in near_by_sketch(pairs, nodes.select("node", "n_shingles", "sketch", F.col("half")), 80, 100).collect()}
    assert got == related


def test_sets_of_a_batch():
    """Texts of a batch are hashed together, as one by one, in slices whose memory doesn't grow with the vocabulary."""
    import tracemalloc

    import pyarrow as pa

    from sieve.llm import jaccard
    r = random.Random(4)
    texts = [None, "", " \t", "a", "A b C", "\x00 \x00\x00 \x1c  x"] + ["x" * k + " É" + "y" * (k + 1) for k in range(0, 140, 3)]
    texts += [" ".join(r.choice(("a", "B\x00", "c" * 9)) for _ in range(r.randrange(1, 40))) for _ in range(300)]
    rows = pa.record_batch([pa.array(texts)], names=["text"]).slice(2)
    for n, num in ((1, 85), (4, 85), (5, 50)):
        words, scheme = WordHash(), Scheme(num, 100)
        sets = [s[a:b] for _, s, at in jaccard.shingle_sets(rows.column(0), n) for a, b in zip(at, at[1:])]
        assert len(sets) == len(rows) and all(np.array_equal(s, shingles(t, n, words)) for s, t in zip(sets, texts[2:]))
        sets = [s for s in sets if len(s)]
        keys, each = scheme.keys_of(np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets]))
        assert np.array_equal(keys, np.concatenate([scheme.keys(s) for s in sets])) and each.tolist() == [len(scheme.keys(s)) for s in sets]
    many = pa.record_batch([pa.array([0] * 2000), pa.array([" ".join(f"{r.randrange(10 ** 9)}" for _ in range(400)) for _ in range(2000)]),
                            pa.array([0] * 2000)], names=["doc_id", "text", "mark"])
    tracemalloc.start()
    for out in (jaccard._signed([many], 4), jaccard._keyed([many], 4, Scheme(85, 100))):
        for _ in out:
            pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # a cache of 400,000 words alone takes 80 MB


def test_few_edges_are_joined_like_many(spark):
    r = random.Random(4)
    edges = [(r.randrange(-400, 400), r.randrange(-400, 400)) for _ in range(500)] + [(i, i + 1) for i in range(900, 1200)] + [(7, 7)]
    df = spark.createDataFrame(edges, "u long, v long")
    few, many = (sorted(map(tuple, components(df, k).collect())) for k in (1000, 0))
    assert few == many and len(few) > 800
    assert components(df.filter("u = v")).collect() == []


def test_near_pairs_of_groups_match_brute_force():
    """Any cut into batches gives the near pairs of different labels, or a forest that connects the same nodes."""
    import pyarrow as pa

    from sieve.llm.jaccard import _sketches, near_pairs, sketch_bits
    r = np.random.default_rng(8)
    rows, sets = [], {}
    for key in range(60):
        base = r.integers(0, 1 << 63, int(r.choice((40, 300, 1000, 1030, 2060))), dtype=np.uint64)
        for m in range(int(r.integers(2, 14))):
            change = r.random(len(base)) < r.choice((0.0, 0.05, 0.3))
            s = np.unique(np.concatenate((np.where(change, r.integers(0, 1 << 63, len(base), dtype=np.uint64), base),
                                          r.integers(0, 1 << 63, int(r.integers(0, 40)), dtype=np.uint64))))
            node, size = int(r.integers(-1 << 62, 1 << 62)), np.array([len(s)])
            power = sketch_bits(size)
            no = np.array([False])
            half = _sketches(s, size, power - 1, no) if power[0] > 10 else pa.array([None], pa.list_(pa.int64()))
            sets[node] = s
            rows.append((key, int(r.integers(0, 2)), node, int(r.integers(0, 5)) + 100 * key, len(s), _sketches(s, size, power, no)[0].as_py(), half[0].as_py(), bool(r.random() < 0.6)))
    rows.sort(key=lambda x: x[:2])
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_()]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "part", "node", "label", "n", "s", "h", "open"])
    must, may = set(), set()
    for i, x in enumerate(rows):
        for y in rows[:i]:
            if x[:2] == y[:2] and x[3] != y[3] and (x[7] or y[7]):
                pair, same = (max(x[2], y[2]), min(x[2], y[2])), len(np.intersect1d(sets[x[2]], sets[y[2]]))
                if 100 * same >= 80 * (x[4] + y[4] - same):
                    must.add(pair)
                if 100 * same >= 70 * (x[4] + y[4] - same):
                    may.add(pair)
    assert len(must) > 50
    label = {x[2]: x[3] for x in rows}
    for size in (1, 7, 50, 10_000):
        every, forest = ([p for b in near_pairs(table.to_batches(max_chunksize=size), 80, 100, e) for p in zip(*(c.to_pylist() for c in b.columns))]
                         for e in (True, False))
        assert must <= set(every) <= may and len(every) == len(set(every))
        assert set(forest) <= set(every)
        joined = lambda pairs: brute_labels([(label[a], label[b]) for a, b in pairs])
        assert joined(forest) == joined(every)


def brute_labels(edges):
    low = {x: x for e in edges for x in e}
    for _ in low:
        for u, v in edges:
            low[u] = low[v] = min(low[u], low[v])
    return low


def test_tables_written_for_one_run(spark, monkeypatch):
    """Groups of texts that share passages and don't link take a fixed, small number of steps."""
    import sieve.llm.components as C
    import sieve.llm.jaccard as J
    written = []
    for module in (C, J):
        monkeypatch.setattr(module, "saved", lambda df, name, *a, f=module.saved: (written.append(name), f(df, name, *a))[1])
    r = random.Random(6)
    passages = [[f"p{k}x{i}" for i in range(120)] for k in range(3)]
    rows = []
    for i in range(60):
        words = passages[i % 3] + [f"own{r.randrange(10 ** 9)}" for _ in range(40 if i % 2 else 25)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + ["end"] * (i % 4)))]
    got = sorted(map(tuple, jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute(rows, 5, 80, 100)
    assert len(written) <= 26, written


def test_keys_in_blocks_meet_like_rows():
    """Keys that travel in blocks by part give the groups that the single rows give."""
    import pyarrow as pa

    from sieve.llm.jaccard import _dealt, _grouped, _keyed, _nodes, shingle_sets
    texts = [t for _, t in corpus(11)]
    scheme, by_key = Scheme(80, 100), defaultdict(set)
    batches = [pa.record_batch([pa.array(range(lo, lo + 50)), pa.array(texts[lo:lo + 50])], names=["doc_id", "text"]) for lo in range(0, 300, 50)]
    for b in batches:
        for _, sets, bounds in shingle_sets(b.column(1), 4):
            for i, j in zip(bounds[:-1], bounds[1:]):
                for k in scheme.keys(sets[i:j]).view(np.int64).tolist() if j > i else ():
                    by_key[k].add(int(_nodes(sets[i:j], np.array([0, j - i]))[0]))
    want = sorted((k, x, len(v), min(v), place) for k, v in by_key.items() if len(v) > 1 for place, x in enumerate(sorted(v), 1))
    assert len(want) > 500
    for parts in (1, 3, 70_000):
        rows = list(_dealt(_keyed(batches, 4, scheme), parts))
        got = []
        for p in range(3):  # each task has whole parts
            mine = [b.filter(pa.array([x % 3 == p for x in b.column(0).to_pylist()])) for b in rows]
            got += [r for b in _grouped(mine) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert sorted(got) == want
    assert list(_grouped([])) == []
