"""Alignment against a brute force over whole texts, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sieve.llm import alignment
from sieve.llm.alignment import Aligner, align, aligned_tokens, default_pieces, pack, ranks, unpack
from sieve.llm.encoding import default_tokenizer


def brute(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    chars = {}
    extra = 256
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255:
            chars[chr(x)] = x
        else:
            chars[chr(extra)] = x
            extra += 1
    out, every = [], Counter()
    for doc, text in rows:
        zero = [doc, 0, 0, 0, 0, "", Counter()]
        if not text:
            out.append(zero)
            continue
        ea = a.encode(" " + text, add_special_tokens=False)
        ta = [(i, bytes(chars[c] for c in t)) for i, t in zip(ea.ids, ea.tokens)]
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        tb = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        raw = (" " + text).encode()
        if b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
            out.append(zero)
            continue
        links, groups, i, j = Counter(), [], 0, 0
        ga, gb, pa_, pb = [], [], 0, 0
        while i < len(ta) or j < len(tb):
            if pa_ <= pb and i < len(ta):
                ga.append(str(ta[i][0]))
                pa_ += len(ta[i][1])
                i += 1
            else:
                gb.append(str(tb[j][0]))
                pb += len(tb[j][1])
                j += 1
            if pa_ == pb:
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
        sa = np.cumsum([0] + [len(x) for _, x in ta])
        sb = np.cumsum([0] + [len(x) for _, x in tb])
        for x in range(len(ta)):
            for y in range(int(np.searchsorted(sb, sa[x], "right")) - 1, len(tb)):
                if sb[y] >= sa[x + 1]:
                    break
                links[ta[x][0], tb[y][0]] += 1
        every += links
        out.append([doc, len(ta), len(tb), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links])
    most = Counter()
    for (_, y), n in every.items():
        most[y] = max(most[y], n)
    return sorted((*r[:6], sum(n for p, n in r[6].items() if every[p] == most[p[1]]), sum(n * every[p] for p, n in r[6].items())) for r in out)


ODD = ["x▁y", "  two  spaces ", "\n", " \n a", "a\n\nb", "tab\tand\r\n", "a\x00b", "  nbsp 　x", "<|endoftext|> <s> </s><0x41>", "日本語 テキスト 😀👍🏽",
       "word," * 50, "é" * 400, "don't I'll we've", "1234567 89", "a  b\x85c \x1cd", "﻿bom", " ", "....!!!", "é combining", "under_score a-b/c"]


def test_matches_brute_force(spark, monkeypatch):
    r = random.Random(5)
    words = ["alpha", "Beta,", "naïve", "ünder", "x", "(see", "2024)", "日本", "\n", "foo\nbar", "", "don't", "antidisestablishmentarianism"]
    rows = list(enumerate(ODD + [" ".join(r.choice(words) for _ in range(r.randint(1, 80))) for _ in range(40)]))
    rows += [(500, ""), (501, None), (7, "again"), (7, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    for limit in (alignment.PAIRS, 0):
        assert sorted(map(tuple, aligned_tokens(df, limit=limit).collect())) == want


def test_small_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, aligned_tokens(docs).collect())) == brute([tuple(x) for x in docs.collect()])


@pytest.mark.parametrize("block", [1, 40])
def test_blocks_and_full_cache(monkeypatch, block):
    """Texts in blocks and a cache of a few chunks give what whole texts give."""
    monkeypatch.setattr(alignment, "_BLOCK", block)
    monkeypatch.setattr(alignment, "CACHE", 5)
    al = Aligner(default_tokenizer(), default_pieces())
    assert al.cuts
    for text in ODD + ["several words, and\na line end more"]:
        got = al.text(al.blocks(text))
        assert (1, *got[:5]) == brute([(1, text)])[0][:6]


def test_ranks_and_links():
    r = np.random.default_rng(3)
    for n, m in ((1, 1), (3, 900), (64, 65), (65, 64), (700, 9000), (5000, 5100)):
        long = np.unique(r.integers(1, 40_000, m))
        short = np.unique(np.append(r.integers(1, long[-1] + 1, n), long[-1]))
        assert np.array_equal(ranks(short, long), np.searchsorted(long, short))
        for a, b in ((short, long), (long, short)):
            ga, gb, la, lb = align(a, b)
            assert np.array_equal(a[ga], np.intersect1d(a, b)) and np.array_equal(b[gb], np.intersect1d(a, b))
            sa, sb = np.append(0, a[:-1]), np.append(0, b[:-1])
            if len(a) * len(b) < 2_000_000:
                want = np.argwhere((sa[:, None] < b[None]) & (sb[None] < a[:, None]))
                assert sorted(zip(la.tolist(), lb.tolist())) == sorted(map(tuple, want.tolist()))


def test_packing():
    pairs, counts = np.array([0, 5, 70_000, 0xFFFFFFFF], np.uint32), np.array([1, 300, 2, 70_000])
    p, c = unpack(pack(pairs, counts))
    assert np.array_equal(p, pairs) and np.array_equal(c, counts)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, pairs string")
    assert aligned_tokens(empty).collect() == []
    rows = [(None, "a b"), (None, None), (3, "▁"), (4, "long words " * 200_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")
    got = {(r.doc_id, r.n_a, r.n_groups > 0, r.groups_sha256 != "") for r in aligned_tokens(df).collect()}
    assert got == {(None, 2, True, True), (None, 0, False, False), (3, 0, False, False), (4, 400_001, True, True)}
