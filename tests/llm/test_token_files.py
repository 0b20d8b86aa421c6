"""Token files: ids equal whole-text encoding, exact round trip, ranges, damage."""

import os
import random
from array import array
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from sieve.llm.encoding import default_tokenizer, encoder
from sieve.llm.token_files import FrameReader, read_token_files, write_token_files


def plain():
    return Tokenizer.from_file(default_tokenizer())


def test_chunked_ids_equal_whole_texts():
    t, e, r = plain(), encoder(default_tokenizer()), random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\x1c", " ", " ", "a", "don't", "'s", "1", "23", "é", "…", "!?", ".", ",", "b", "\n", "😀", "中文", "_", "\x00", "Word", "<|endoftext|>", "\r\n", "\x85"]
    texts = ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "a\n  b  "] + ["".join(r.choice(parts) for _ in range(r.randrange(1, 25))) for _ in range(3000)]
    for x in texts:
        assert np.frombuffer(e.ids(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_round_trip(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    manifest = write_token_files(docs, frame_ids=2000)
    got = read_token_files(manifest).orderBy("start").collect()
    t, start = plain(), 0
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for g, r in zip(got, rows):
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert g.ids == ids and g.start == start and g.n_tokens == len(ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = read_token_files(manifest, doc_ids={5, 77, 10**9}, with_ids=False).collect()
    want = {r.doc_id: r for r in got}
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in some) == sorted((d, want[d].start, want[d].ids_crc32) for d in (5, 77))
    path = manifest.first().path.removeprefix("file:")
    with open(path, "rb") as f:  # any zstandard reader takes the whole file
        raw = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert np.frombuffer(raw[:4 * got[0].n_tokens], "<u4").tolist() == got[0].ids


def test_damage_and_partial_reads(tmp_path, spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 300) for i in range(40)], "doc_id long, text string").coalesce(1)
    path = write_token_files(docs, frame_ids=4000).first().path.removeprefix("file:")

    class Counted:
        def __init__(self, raw):
            self.raw, self.at, self.read_bytes = raw, 0, 0

        def size(self):
            return len(self.raw)

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.read_bytes += n
            return self.raw[self.at:self.at + n]

    with open(path, "rb") as f:
        raw = bytearray(f.read())
    c = Counted(bytes(raw))
    r = FrameReader(c)
    before = c.read_bytes
    r.ids(20)
    assert c.read_bytes - before < len(raw) / 4
    raw[int(r.start[0]) + 30] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        FrameReader(Counted(bytes(raw))).ids(0)
    assert os.path.exists(path)


def test_edges(spark):
    rows = [(5, None, 1), (5, "", 2), (5, "b a", 3), (None, "x", 4), (1, "y " * 90_000, 5)]
    got = read_token_files(write_token_files(spark.createDataFrame(rows, "doc_id long, text string, start long"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 5, 5, 5]
    assert [r.ids for r in got][2:4] == [[2], [2]] and got[1].n_tokens > 90_000
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert read_token_files(write_token_files(empty)).count() == 0


def test_rows_of_one_id_are_dealt_out_and_order_of_the_caller(spark):
    """Rows that share a null id go to several files; with an order, files hold documents in it."""
    from pyspark.sql import functions as F
    docs = spark.range(4000).select(F.when(F.col("id") % 10 > 6, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
                                    ((F.col("id") * 7919) % 4001).alias("position")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = write_token_files(docs)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.agg(F.max("n_docs")).first()[0] < 1500 and manifest.count() > 4
    got = [r.doc_id for r in read_token_files(manifest).orderBy("start").collect()]
    assert got == [None] * 2800 + sorted(r.doc_id for r in docs.filter("doc_id is not null").collect())
    t, text_at = plain(), {r.text: r.position for r in docs.collect()}
    rows = read_token_files(write_token_files(docs, order=[F.col("position")])).orderBy("start").collect()
    places = [text_at[t.decode(r.ids[:-1])] for r in rows]
    assert places == sorted(places) and len(places) == 4000


def test_words_skip_the_tokenizer_and_stay_known(monkeypatch):
    """Words of letters alone are encoded by the model; a full cache keeps what is met again."""
    from sieve.llm import encoding
    monkeypatch.setattr(encoding, "CACHE", 40)
    e, asked, made = encoding.ChunkEncoder(default_tokenizer()), [], []
    whole, tokenize = e.whole, e.model.tokenize
    e.whole = lambda t: (asked.append(t), whole(t))[1]
    e.model = type("Model", (), {"tokenize": staticmethod(lambda t: (made.append(t), tokenize(t))[1])})
    text = "Ab " + " ".join(f"the éß xw{chr(97 + i % 26)}{chr(97 + i // 26)} ñandú" for i in range(300))
    assert e.ids(text) == array("I", e.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    assert not asked and len(made) == 304 and len(e.after_space) <= 40
