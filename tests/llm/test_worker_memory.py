"""What Python workers hold: bounded Arrow batches, and nothing of other operators."""

import weakref

import pyarrow as pa

import corpus_pipeline as pipe
from sieve import session
from sieve.llm import _common
from sieve.llm.encoding import default_tokenizer, encoder

SF = "/root/testdata/sf0.001"


def test_a_worker_drops_what_other_operators_keep():
    first = encoder(default_tokenizer())
    first.ids("some words here")
    seen = weakref.ref(first)
    assert encoder(default_tokenizer()) is first  # kept for the next task of the same operator
    del first
    batch = pa.record_batch([pa.array([1])], names=["x"])
    assert list(_common.in_worker("other", lambda batches: batches)([batch])) == [batch]
    assert seen() is None


def test_batches_are_bounded_by_bytes(spark):
    def run(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    docs = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('word ', 200) AS text")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for bound, own in ((1 << 18, None), (1 << 18, str(1 << 19))):
        if own:
            spark.conf.set(key, own)
        try:
            sizes = session.materialize(docs.mapInArrow(run, "n long, size long"), "batches", bound).collect()
            assert spark.conf.get(key, None) == own
        finally:
            spark.conf.unset(key)
        assert sum(r.n for r in sizes) == 4000
        assert max(r.size for r in sizes) < 1.1 * int(own or bound)


def test_stages_bound_their_text_batches(spark, monkeypatch):
    bounds = {}

    def seen(df, name="t", batch_bytes=None):
        bounds[name] = batch_bytes
        return real(df, name, batch_bytes)

    real = session.materialize
    monkeypatch.setattr(_common, "materialize", seen)
    pipe.run(spark, SF)
    texts = {"tox-features", "jac-signatures", "jac-groups", "jac-links", "dec-found", "token-manifest"}
    assert {k for k, v in bounds.items() if v} == texts
