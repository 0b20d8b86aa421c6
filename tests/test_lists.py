"""Stored cluster lists: repeatable centroids, whole lists, pruned folders."""

import re

import numpy as np

from sieve.operators import ivf
from sieve.operators import vectorsearch as vs


def _vectors(spark, n=300, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(3)], -1) for i in range(n)]
    rows += [(n, [0.0] * 6, -1), (n + 1, None, -1), (n + 2, rows[0][1], -1)]
    return rows, spark.createDataFrame(rows, "doc_id long, vec array<double>, near int")


def _brute_centroids(rows, lists):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows if v and any(v)}
    chosen = [unit[min(unit)]]
    while len(chosen) < lists:
        near = {i: max(round(float(u @ c), 6) for c in chosen) for i, u in unit.items()}
        chosen.append(unit[min(near, key=lambda i: (near[i], i))])
    return np.array(chosen)


def test_centroids_and_lists_equal_brute_force(spark, tmp_path):
    rows, df = _vectors(spark)
    cents, stored = ivf.build_lists(df, str(tmp_path / "lists"), lists=5, rows_per_file=20)
    want = _brute_centroids(rows, 5)
    assert np.allclose(cents, want)
    got = {r["doc_id"]: r["list_id"] for r in stored.collect()}
    assert sorted(got) == sorted(i for i, v, _ in rows if v)
    for i, v, _ in rows:
        if v and any(v):
            u = np.array(v) / np.linalg.norm(v)
            assert got[i] == int(np.argmax([round(float(u @ c), 6) for c in want]))
    assert got[300] == 0
    largest = max(got.values(), key=list(got.values()).count)
    assert len(list((tmp_path / "lists" / f"list_id={largest}").glob("*.parquet"))) > 1


def test_search_reads_probed_folders_only(spark, tmp_path):
    rows, df = _vectors(spark)
    cents, stored = ivf.build_lists(df, str(tmp_path / "lists"), lists=5)
    q = spark.createDataFrame([(1, rows[7][1])], "query_id long, vec array<double>")
    found = ivf.ivf_search(q, cents, stored, k=4, nprobe=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*list_id#\d+ IN", plan), plan
    lists = {r["doc_id"]: r["list_id"] for r in stored.collect()}
    sims = [round(float(np.array(rows[7][1]) / np.linalg.norm(rows[7][1]) @ c), 6) for c in cents]
    probed = sorted(range(5), key=lambda j: (-sims[j], j))[:2]
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1.0)
    want = sorted((-round(float(unit(rows[7][1]) @ unit(v)), 6), i) for i, v, _ in rows if v and lists[i] in probed)[:4]
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == [i for _, i in want]
    whole = ivf.ivf_search(q, cents, stored, k=9, nprobe=5).collect()
    exact = vs.knn(q, df.select("doc_id", "vec"), k=9).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, exact))


def test_empty_and_equal_vectors(spark, tmp_path):
    _, df = _vectors(spark, 3)
    cents, stored = ivf.build_lists(df.limit(0), str(tmp_path / "none"), lists=3)
    assert stored.count() == 0
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(4)], "doc_id long, vec array<double>")
    cents, stored = ivf.build_lists(same, str(tmp_path / "same"), lists=3)
    assert len(cents) == 1 and stored.count() == 4
