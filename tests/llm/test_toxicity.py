"""Toxicity: held-out accuracy, the split, features and edge cases."""

import zlib

import pytest

from sieve.llm.toxicity import FEATURES, LEXICON, WordCodes, features_of, score_documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return score_documents(docs, labels).collect(), {r.doc_id: r.toxic for r in labels.collect()}, docs.count()


def test_held_out_accuracy(scored):
    rows, labels, n = scored
    assert len(rows) == n
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.96 * len(held)
    assert sum(p and y for p, y in held) >= 0.75 * sum(y for _, y in held)


def test_features():
    c = WordCodes(LEXICON, [("blorp", False), ("grun*", True)])
    f = dict(zip(FEATURES, features_of("You are an idiot , st*pid 1diot STUUUPID blorp!! grunzet", c)))
    assert f["lexicon"] == 1 / 10 and f["learned"] == 2 / 10 and f["strong"] == 1 / 10 and f["obfuscated"] == 3 / 10
    assert f["near_second"] > 0 and f["marks"] > 0 and f["shouted"] > 0
    assert features_of(None, c) == features_of(" \n", c) == [0.0] * len(FEATURES)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "you idiot", "z"), (5, "a " * 60_000, None)],
                                 "doc_id long, text string, label string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = score_documents(docs, none).collect()
    assert len(rows) == 5 and len({r.score for r in rows}) == 1
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 1), (1, 0)], "doc_id long, toxic int")
    assert score_documents(docs, odd).count() == 5
    assert score_documents(docs.limit(0), odd).count() == 0


def test_documents_with_one_common_long_word_all_count(spark):
    """Only near copies count once, not all documents with the same long word."""
    from sieve.llm.toxicity import learned_words
    rows = [(f"somewhere zorg a{i} b{i} c{i}", 1.0) for i in range(4)] + [("everywhere blarg d e f", 1.0)] * 4
    rows += [(f"elsewhere fine x{i} y{i}", 0.0) for i in range(40)]
    got = {w for w, _ in learned_words(spark.createDataFrame(rows, "text string, label double"))}
    assert "zorg" in got and "blarg" not in got


def test_codes_of_words_met_first():
    """Words known at first sight to be plain get the code that the full rules give."""
    import random

    from sieve.llm.toxicity import LEXICON, SECOND_PERSON, WordCodes
    r = random.Random(3)
    codes = WordCodes(LEXICON, [("wort", True), ("tost*", False), ("abei*", True), ("stueti*", False), ("idiot*", True)])
    assert codes["Maison"] == codes["été,"] == codes["(Haus)"] == 0 and codes["debile."] == 0 != codes["DÉBILE"] != codes["débile"]
    chars = "abeioustABEIOUST.,;:?!\"'()_-*01345$@|éüßÉÜñ̇İıſŒœªº漢Σσς½²"
    known = [*LEXICON, *SECOND_PERSON, "wort", "tost", "abei", "stueti"]
    for _ in range(30_000):
        w = list(r.choice(known) if r.random() < 0.5 else "".join(r.choice(chars) for _ in range(r.randrange(1, 9))))
        for _ in range(r.randrange(3)):
            w.insert(r.randrange(len(w) + 1), r.choice(chars))
        w = "".join(w).upper() if r.random() < 0.2 else "".join(w)
        assert codes[w] == codes.code(w), w
