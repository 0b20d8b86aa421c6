"""Embedding fixtures (reference unit tests + worked values)."""

import numpy as np
from pyspark.sql import functions as F

from sieve.functions.text import embed_tokens, fnv1a32
from sieve.operators.embedding import embed_vectors, hashed_vectors_np

WORKED = {
    "postgres indexing": {32: 0.333333, 78: 0.666667, 109: 0.666667},
    "postgres indexing basics": {32: 0.267261, 74: 0.534522, 78: 0.534522, 106: 0.267261, 109: 0.534522},
    "hello world": {19: 0.666667, 43: 0.666667, 119: 0.333333},
    "some words here": {10: 0.534522, 22: 0.267261, 72: 0.267261, 75: 0.534522, 113: 0.534522},
    "": {},
}
HASHES = {"": 2166136261, "postgres": 3503556430, "indexing": 221647213, "basics": 2154995914,
          "hello": 1335831723, "bg:postgres_indexing": 440515488, "bg:indexing_basics": 54244970}


def _nz(v):
    return {i: round(x, 6) for i, x in enumerate(v) if x != 0}


def test_numpy_embedder_worked_values():
    m = hashed_vectors_np(list(WORKED))
    for row, (text, want) in zip(m, WORKED.items()):
        assert _nz(row) == want, text
        assert len(row) == 128


def test_spark_paths_agree_with_worked_values(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(WORKED)], "doc_id long, text string")
    for method in ("arrow", "native"):
        got = {r.doc_id: _nz(r.vec) for r in embed_vectors(df, method=method).collect()}
        for i, want in enumerate(WORKED.values()):
            assert got[i] == want, method


def test_fnv_hash_values(spark):
    df = spark.createDataFrame([(k,) for k in HASHES], "g string")
    got = {r.g: r.h for r in df.select("g", fnv1a32(F.col("g")).alias("h")).collect()}
    assert got == HASHES


def test_tokenizer_and_unit_norm(spark):
    df = spark.createDataFrame([("B-tree, GIN a x1 Über",)], "t string")
    assert df.select(embed_tokens(F.col("t")).alias("x")).first().x == ["tree", "gin", "x1", "ber"]
    m = hashed_vectors_np(["some words here", "deterministic text", "x"])
    assert np.allclose(np.linalg.norm(m[:2], axis=1), 1.0)
    assert not m[2].any()  # one-letter text -> zero vector
    assert np.array_equal(hashed_vectors_np(["same text"]), hashed_vectors_np(["same text"]))
