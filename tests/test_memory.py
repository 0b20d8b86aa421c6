"""Memory of Python tasks doesn't grow with the rows of a batch or the queries."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from sieve.operators.embedding import _embedded, hashed_vectors_np
from sieve.operators.vectorsearch import _make_scorer, _score_matrix


def _peak(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _vectors(n, seed):
    return np.random.default_rng(seed).integers(-2, 3, (n, 4)).astype(float)


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_scores_are_tiled(metric):
    docs, ids, k = _vectors(5000, 1), np.arange(5000)[::-1], 7
    bc = SimpleNamespace(value=(np.arange(3000), _vectors(3000, 2)))
    batches = [pd.DataFrame({"doc_id": ids[a:a + 2500], "dv": list(docs[a:a + 2500])}) for a in (0, 2500)]
    got, peak = _peak(lambda: pd.concat(_make_scorer(bc, metric, k, True)(batches)))
    assert peak < 130e6  # a whole batch of scores alone takes 60 MB, and four such stood at once
    best = got.sort_values(["query_id", "key", "doc_id"])
    assert len(best) == 3000 * k
    for q in range(0, 3000, 251):  # few distinct values: many ties at the limit
        key = _score_matrix(metric, docs, bc.value[1][q:q + 1], np.linalg.norm(bc.value[1][q:q + 1], axis=1))[0][:, 0]
        own = ids != q
        want = np.lexsort((ids[own], key[own]))[:k]
        mine = best[best.query_id == q]
        assert mine.doc_id.tolist() == ids[own][want].tolist()
        assert mine.key.tolist() == key[own][want].tolist()


def test_fewer_documents_than_places():
    bc = SimpleNamespace(value=(np.array([0, 9]), np.eye(2)))
    got = pd.concat(_make_scorer(bc, "cosine", 5, True)([pd.DataFrame({"doc_id": [0, 1], "dv": list(np.eye(2))})]))
    assert sorted(zip(got.query_id, got.doc_id)) == [(0, 1), (9, 0), (9, 1)]
    assert list(_make_scorer(bc, "cosine", 5, True)([])) == []


def test_texts_are_hashed_in_slices():
    texts = [f"word{i} other words here number {i} " * 400 for i in range(400)] + ["", None, "alone here"]
    whole = hashed_vectors_np(texts, slice_chars=1 << 40)
    got, peak = _peak(lambda: hashed_vectors_np(texts))
    assert np.array_equal(got, whole)
    assert np.array_equal(hashed_vectors_np(texts[-50:], slice_chars=1), whole[-50:])
    assert peak < 80e6  # at once these 5.7 million characters take 165 MB


def test_batches_are_embedded_in_pieces():
    texts = [f"word{i} some other words here {i % 7} " * 10 for i in range(9998)] + [None, ""]
    rows = pa.record_batch([pa.array(range(10000)), pa.array([3] * 10000), pa.array(texts)], names=["doc_id", "k", "_text"])
    whole, seen = hashed_vectors_np(texts), 0

    def run():
        nonlocal seen
        for out in _embedded([rows], 128, ["doc_id", "k"], "vec"):
            assert out.schema.names == ["doc_id", "k", "vec"] and out.num_rows <= 256
            assert out.column(0).to_pylist() == list(range(seen, seen + out.num_rows))
            assert np.array_equal(out.column(2).flatten().to_numpy().reshape(-1, 128), whole[seen:seen + out.num_rows])
            seen += out.num_rows

    assert _peak(run)[1] < 25e6 and seen == 10000  # the texts and vectors of the batch alone take 15 MB as Python and NumPy objects, three times over
