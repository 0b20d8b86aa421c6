"""Exact top-k against a plain loop."""

import math
import random

import pytest

from sieve.llm.topk import scaled, top_k
from pyspark.sql import functions as F


def test_matches_plain_loop(spark):
    r = random.Random(3)
    rows = [(i, [float(r.choice((0, 0, 1, -2, 3))) for _ in range(r.choice((3, 6, 0)))]) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, terms array<double>").repartition(5)
    want = []
    for q, v in rows[::10]:
        got = sorted(((-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in rows if i != q))[:7]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(got, 1)]
    for block in (8192, 4):
        got = top_k(df.filter("id % 10 = 0"), df, 7, block).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_edges(spark):
    schema = "id long, v array<float>, score int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [nan], 1), (4, [inf], 1), (None, [1.0], 1), (5, [1.0], 1), (5, [1.0], 1), (6, [], 1), (7, [1e9], 1)]
    df = spark.createDataFrame(rows, schema).select("id", scaled(F.col("v")).alias("terms"))
    assert df.filter("id = 0").first().terms == [512, -2]
    got = sorted(map(tuple, top_k(df.filter("id = 0"), df).collect()))
    assert got == [(0, 1, 7, 512 * 1024 * 10 ** 9), (0, 2, 5, 524288), (0, 3, 5, 524288), (0, 4, 6, 0)]
    assert top_k(df.limit(0), df).count() == 0 and top_k(df, df.limit(0)).count() == 0


def test_components_of_any_size(spark):
    """Scores are exact however large the components are; one that leaves 64 bits is an error only in the result."""
    rows = [(100, [3.0, 5.0]), (1, [200_000.0, 0.0]), (2, [0.1, 0.2]), (3, [5e12, -3e12]), (4, [2.0 ** 40, -2.0 ** 40]), (5, [1e300, -1e300]), (200, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").select("id", scaled(F.col("v")).alias("terms")).repartition(3)
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    part = df.filter("id != 5")
    want = sorted((-sum(a * b for a, b in zip(whole[100], whole[i])), i) for i in whole if i not in (100, 5))
    got = top_k(df.filter("id = 100"), part).collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, -s) for s, i in want]
    assert top_k(df.filter("id = 100"), df, 3).collect() == got[:3]  # id 5 lies far below
    assert {r.score for r in top_k(df.filter("id = 200"), df).collect()} == {0}
    with pytest.raises(Exception, match="fit into a long"):
        top_k(df.filter("id = 100"), df).collect()
    near = spark.createDataFrame([(0, [2.0 ** 40, 1.0]), (1, [2.0 ** 22, 7.0]), (2, [2.0 ** 22, 9.0])], "id long, terms array<double>")
    assert [(r.vec_id, r.score) for r in top_k(near.filter("id = 0"), near).collect()] == [(2, 2 ** 62 + 9), (1, 2 ** 62 + 7)]
