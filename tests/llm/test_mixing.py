"""Mixing: SQL, targets by plain iteration, positions by numeric inversion, edge cases."""

import pytest
from pyspark.sql import functions as F

from sieve.llm.mixing import curriculum, integrated, mixed, targets, training_time


def test_targets_match_plain_iteration(spark):
    for sizes, weights in (([10, 1000, 300, 50, 0], [5, 2, 1, 5, 2]), ([7, 7, 7], [1, 1, 1]), ([5, 900], [9, 1]), ([0, 0], [1, 2])):
        want, capped, share = [0.0] * len(sizes), set(), 1.5
        while True:
            left = share * sum(sizes) - sum(2 * sizes[i] for i in capped)
            rest = [i for i in range(len(sizes)) if i not in capped]
            w = sum(weights[i] for i in rest)
            over = [i for i in rest if left * weights[i] / w > 2 * sizes[i] + 1e-9]
            for i in rest:
                want[i] = left * weights[i] / w
            for i in over:
                want[i] = 2.0 * sizes[i]
            if not over:
                break
            capped |= set(over)
        df = spark.createDataFrame([(str(i), s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))], "key string, source_size long, weight double")
        got = [r.target for r in targets(df, 1.5, 2.0).orderBy("key").collect()]
        assert got == pytest.approx(want)


def test_training_time_inverts_the_integral(spark):
    knots = [(0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (0.75, 0.0), (1.0, 2.0)]
    s = integrated(spark.createDataFrame([("=a", knots)], "key string, knots array<struct<t:double,w:double>>"))
    us = [i / 20 for i in range(21)]
    got = [r.t for r in s.withColumn("u", F.explode(F.array(*[F.lit(u) for u in us])))
           .select("u", training_time(F.col("u"), F.col("pieces"), F.col("weight")).alias("t")).orderBy("u").collect()]

    def spent(t):
        total = 0.0
        for (t1, w1), (t2, w2) in zip(knots, knots[1:]):
            x = min(max(t - t1, 0), t2 - t1)
            total += x * w1 + (w2 - w1) / (t2 - t1) * x * x / 2
        return total

    assert [spent(t) / spent(1.0) for t in got] == pytest.approx(us, abs=1e-9)
    assert got == sorted(got)


def test_taken_words(spark):
    rows = [(i, f"s{i % 4}" if i % 7 else None, "w " * (i * 13 % 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = curriculum(df, bucket_rows=10).collect()
    assert len(got) == 400
    by = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        assert sum(r.taken for r in rs) == round(rs[0].target) and sum(r.size for r in rs) == rs[0].source_size
    again = curriculum(df.repartition(7), bucket_rows=10).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sorted(map(str, got)) == sorted(map(str, curriculum(df).collect()))
    whole = curriculum(df, whole=True).collect()
    for r in whole:
        assert r.taken in (0, r.size, 2 * r.size)
    out = mixed(df).collect()
    assert len(out) == sum(len(r.copies) for r in whole) and set(out[0].asDict()) == {"doc_id", "source", "text"}



def test_edges(spark):
    schema = "doc_id long, source string, text string, size string, key long"
    rows = [(1, None, None, "a", 1), (1, None, None, "a", 1), (None, "", "a b", None, 2), (3, "", " \t", "", 3), (4, "x", "w " * 50_000, "", 4)]
    df = spark.createDataFrame(rows, schema)
    got = curriculum(df).collect()
    assert len(got) == 5 and sum(r.taken for r in got) == pytest.approx(1.5 * 50_002, abs=2)
    assert [c for c in mixed(df).columns] == df.columns
    assert curriculum(df.limit(0)).count() == 0 and mixed(df.limit(0)).count() == 0
    assert curriculum(df.filter("text is null")).agg(F.sum("taken")).first()[0] == 0


def test_equal_rows_across_the_edge_of_a_target(spark):
    """Rows equal in id, source and text that straddle the target's edge are taken as often as the plan takes them."""
    rows = [(None if i < 60 else i, "s", "a b c" if i < 60 else "d e f", i) for i in range(100)]
    rows += [(1_000, None, "x y z", i) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, nr int").repartition(5)
    for share in (0.2, 0.5, 1.3):
        plan = curriculum(df, share=share, whole=True).collect()
        assert share != 0.5 or len({len(r.copies) for r in plan if r.doc_id is None}) == 2
        out = mixed(df, share=share).collect()
        count = lambda xs: {k: sum(n for r, n in xs if (r.doc_id, r.source) == k) for k in {(r.doc_id, r.source) for r, n in xs if n}}
        assert count([(r, 1) for r in out]) == count([(r, len(r.copies)) for r in plan])
        assert max(sum(x.nr == r.nr for x in out if (x.doc_id, x.source) == (r.doc_id, r.source)) for r in out) <= 2
