"""Attribution against the library's own offsets, hand-worked boundaries, sums."""

import re

import numpy as np
from tokenizers import Tokenizer

from sieve.llm.encoding import default_tokenizer
from sieve.llm.token_counts import SENTENCES, attributed, token_counts


def test_rule():
    # tokens 0-3, 3-7, 7-8; sections 0-5, 5-6, 6-8: the middle token has 2, 1 and 1 bytes
    assert attributed(np.array([3, 7, 8]), np.array([5, 6, 8]))[0].tolist() == [0, 0, 2]
    assert attributed(np.array([4]), np.array([1, 4]))[0].tolist() == [1]
    assert attributed(np.array([4]), np.array([1, 4]), "first")[0].tolist() == [0]
    assert attributed(np.array([4]), np.array([2, 4]))[0].tolist() == [0]


def test_against_library_offsets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = docs.collect()
    df = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    got = {}
    for r in token_counts(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    t = Tokenizer.from_file(default_tokenizer())
    for d in rows:
        mine = sorted(got[d.doc_id], key=lambda r: r.section)
        enc = t.encode(d.text, add_special_tokens=False)
        assert sum(r.n_tokens for r in mine) == len(enc.ids)
        if d.text.isascii():
            cuts = [m.end() for m in re.finditer(SENTENCES, d.text)]
            cuts += [len(d.text)] * (not cuts or cuts[-1] != len(d.text))
            want = [0] * len(cuts)
            for a, b in enc.offsets:
                parts = [max(0, min(b, hi) - max(a, lo)) for lo, hi in zip([0, *cuts], cuts)]
                want[parts.index(max(parts))] += 1
            assert [r.n_tokens for r in mine] == want and [r.end for r in mine] == cuts


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "a. b\n\nc é", 1), (2, "x " * 60_000, 1)], "doc_id long, text string, section int")
    got = token_counts(df).collect()
    assert [(r.section, r.n_tokens) for r in got if r.doc_id == 1] == [(0, 0), (0, 0)]
    assert [(r.start, r.end) for r in got if r.doc_id is None] == [(0, 2), (2, 5), (5, 6), (6, 10)]
    assert sum(r.n_tokens for r in got if r.doc_id == 2) >= 60_000
    assert token_counts(df.limit(0)).count() == 0
    cross = token_counts(spark.createDataFrame([(1, "there")], "doc_id long, text string"), sections="th").collect()
    assert sum(r.n_tokens for r in cross) == 1
