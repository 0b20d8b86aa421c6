"""Stages of the corpus pipeline judge rows, not ids."""

import corpus_pipeline as pipe
from sieve.llm.toxicity import score_documents

SF = "/root/testdata/sf0.01"


def test_toxicity_by_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    scored = score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).select("doc_id", "predicted")
    rows = docs.join(scored, "doc_id").dropDuplicates(["text"]).collect()
    bad, good = ([r.text for r in rows if r.predicted == p][:3] for p in (1, 0))
    assert len(bad) == len(good) == 3
    more = [(d, t) for d in (None, 10**9) for t in bad + good]
    out = pipe.toxicity(spark, docs.union(spark.createDataFrame(more, "doc_id long, text string")), SF).collect()
    got = sorted(((r.doc_id, r.text) for r in out if r.doc_id in (None, 10**9)), key=str)
    assert got == sorted([(d, t) for d in (None, 10**9) for t in good], key=str)


def test_near_duplicates_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(None, a), (None, a), (None, a + " end"), (None, b), (7, b + " end"), (7, c), (7, c), (9, c + " end"), (9, "other text of this id"),
            (None, None), (None, ""), (11, "lone words"), (11, "more lone words")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.text) for r in pipe.ngram_jaccard(spark, df, SF).collect()), key=str)
    one = [x for x in got if x[1] and x[1].startswith("a0")]
    assert len(one) == 1 and one[0][0] is None
    assert got == sorted(one + [(7, b + " end"), (7, c), (9, "other text of this id"), (None, None), (None, ""), (11, "lone words"), (11, "more lone words")], key=str)


def test_leaks_by_row(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, "say " + item), (None, "nothing here"), (None, None), (5, item), (5, "nothing there")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in pipe.decontamination(spark, df, SF).collect()), key=str)
    assert got == sorted([(None, "nothing here"), (None, None), (5, "nothing there")], key=str)
