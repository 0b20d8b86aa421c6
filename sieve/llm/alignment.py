"""Alignment of the tokens of two tokenizers by galloping intersection.

Both tokenizers cut the same bytes, so a text is two rising lists of byte
offsets at which tokens end.  The shorter list drives a search into the longer:
from a start that is known to lie before it, each offset doubles its step until
it has passed its place, then halves the range (an array's offsets all at
once).  Offsets found in both lists are the ends of groups; the ranks at a
token's two ends differ by the number of the other side's tokens it overlaps,
which gives the links.

* **Chunks.**  A text is cut before spaces that follow something else, and
  around lone line ends.  No token of either side spans such a cut (pieces of
  the byte-level tokenizer only begin with white space; of the piece tokenizer
  no piece holds a space after another character, nor a line end, which is
  checked when it is loaded), so cuts are ends of groups and the alignment of a
  text is its chunks' one after the other.  Each distinct chunk is encoded and
  aligned once and kept in a bounded cache; a batch's new chunks are encoded
  and aligned together.  A mark that ends a chunk behind a letter is a token of
  its own on both sides (checked too), so a word with a mark is put together
  from the two.  Tests compare with whole texts.
* **Counts.**  A document's distinct id pairs travel packed in one column.
  Corpus counts are combined in the tasks before they are summed.  There are at
  most |A| x |B| id pairs; up to ``PAIRS`` of them are broadcast, more are
  joined by a shuffle.

Edge cases: null and empty texts, and texts whose tokens' bytes differ from the
text (such as those with U+2581), have no tokens and no part in the counts;
long texts are worked through in blocks; a null or repeated id keeps its rows;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ._common import python_ready, saved
from .encoding import default_tokenizer

#: Id pairs that are broadcast at most (13 bytes each).
PAIRS = 4_000_000
#: Chunks in a task's cache (about 350 bytes each).
CACHE = 600_000
#: Characters worked through at once.
_BLOCK = 1 << 20
_STRIDE = 64
_CUT = re.compile(r"(?<=\S)(?= )|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
_ENDED = re.compile(r".*[A-Za-zÀ-ÖØ-öø-ɏ][.,;:!?]", re.DOTALL).fullmatch
_BAD = b"!"
_LOADED: dict[tuple[str, str], Aligner] = {}


def default_pieces() -> str:
    """Path of the public piece model installed beside the libraries."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


# -- ends --------------------------------------------------------------------

def ranks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each element of ``short`` how many of ``long`` are smaller; both rise."""
    n, m = len(short), len(long)
    if n <= _STRIDE:
        found, at = np.empty(n, np.int64), 0
        for i, x in enumerate(short.tolist()):  # each starts where the last one ended
            step = 1
            while at + step <= m and long[at + step - 1] < x:
                at += step
                step *= 2
            found[i] = at = at + int(np.searchsorted(long[at:at + step], x, "left"))
        return found
    # every 64th element first; the others start from theirs
    at = np.repeat(ranks(short[::_STRIDE], long), _STRIDE)[:n]
    step = np.ones(n, np.int64)
    go = np.arange(n)
    while len(go):
        to = at[go] + step[go]
        inside = to <= m
        go, to = go[inside], to[inside]
        smaller = long[to - 1] < short[go]
        go, to = go[smaller], to[smaller]
        at[go] = to
        step[go] *= 2
    low, high = at, np.minimum(at + step, m)  # the place lies in low .. high
    go = np.flatnonzero(low < high)
    while len(go):
        middle = (low[go] + high[go]) // 2
        smaller = long[middle] < short[go]
        low[go[smaller]] = middle[smaller] + 1
        high[go[~smaller]] = middle[~smaller]
        go = go[low[go] < high[go]]
    return low


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places in A and in B of the common ends, and the linked tokens' places in A and in B, in order.

    The lists rise strictly and have the same last element."""
    swap = len(a_ends) > len(b_ends)
    short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
    rank = ranks(short, long)
    common = long[rank] == short
    at_short = np.flatnonzero(common)
    at_long = rank[common]
    # a token overlaps the long side's tokens from the rank of its start to that of its end
    first = np.concatenate(([0], rank[:-1] + common[:-1]))
    many = rank - first + 1
    of_short = np.repeat(np.arange(len(short)), many)
    of_long = np.arange(len(of_short)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return (at_long, at_short, of_long, of_short) if swap else (at_short, at_long, of_short, of_long)


# -- tokens ------------------------------------------------------------------

def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner(dict):
    """``(sizes, pairs, groups)`` by chunk: numbers of tokens of either side, packed id pairs, and groups as text."""

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _byte_of_char()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        #: Whether no piece spans a cut or a line end; else texts are encoded whole.
        self.cuts = not any(re.search("[^▁]▁|\n", p) for p in plain) \
            and self.b.encode("\n \n x", out_type=str) == ["▁", "<0x0A>", "▁", "<0x0A>", "▁x"]
        #: Whether a mark that ends a chunk behind a letter is a token of its own.
        self.marks = self.cuts and not any(map(_ENDED, plain))
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.shown = [b"%d%c" % (i, end) for size, ends in ((len(self.a_bytes), b",|"), (len(pieces), b",;")) for end in ends for i in range(size)]
        self.shown_size = np.array([len(x) for x in self.shown])

    def chunks(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def learn(self, chunks: list[str]) -> None:
        """Encode and align chunks."""
        raw = [c.encode() for c in chunks]
        a_ids = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        # the piece tokenizer adds a space in front, and a line end keeps that away from what follows
        if self.cuts:
            b_ids = [ids[2:] for ids in self.b.encode(["\n" + c for c in chunks], num_threads=1)]
        else:
            b_ids = self.b.encode([c[1:] for c in chunks], num_threads=1)
        a_list, b_list = list(chain.from_iterable(a_ids)), list(chain.from_iterable(b_ids))
        a, b = np.array(a_list, np.int64), np.array(b_list, np.int64)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(raw)) for x in (a_ids, b_ids))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        upto_a, upto_b, last = np.cumsum(n_a), np.cumsum(n_b), np.cumsum(list(map(len, raw)))
        joined = b"".join(raw)
        if not (n_a.all() and n_b.all() and np.array_equal(a_end[upto_a - 1], last) and np.array_equal(b_end[upto_b - 1], last)
                and joined == b"".join(map(self.a_bytes.__getitem__, a_list)) == b"".join(map(self.b_bytes.__getitem__, b_list))):
            bad = {k for k, r in enumerate(raw) if not b"".join([self.a_bytes[i] for i in a_ids[k]]) == r == b"".join([self.b_bytes[i] for i in b_ids[k]])}
            self.update((chunks[k], (b"", b"", _BAD)) for k in bad)
            if good := [c for k, c in enumerate(chunks) if k not in bad]:
                self.learn(good)
            return
        group_a, group_b, link_a, link_b = align(a_end, b_end)
        pairs = ((a[link_a] << 16) | b[link_b]).astype("<u4").tobytes()
        # ids as text with what follows them: "," inside a group, "|" after its A ids, ";" at its end
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[group_a] = ends_b[group_b] = 1
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.append(0, group_b + 1)[np.cumsum(ends_a) - ends_a]] = a + ends_a * len(self.a_size)
        code[np.arange(len(b)) + (group_a + 1)[np.cumsum(ends_b) - ends_b]] = b + ends_b * len(self.b_size) + 2 * len(self.a_size)
        groups = b"".join(map(self.shown.__getitem__, code.tolist()))
        to_group = np.cumsum(self.shown_size[code])[upto_a + upto_b - 1].tolist()
        to_pair = (4 * np.searchsorted(link_a, upto_a)).tolist()
        sizes = np.stack((n_a, n_b), 1).astype("<u8").tobytes()
        g = at = 0
        for k, (chunk, g2, at2) in enumerate(zip(chunks, to_group, to_pair)):
            self[chunk] = (sizes[16 * k:16 * k + 16], pairs[at:at2], groups[g:g2 - 1])
            g, at = g2, at2

    def know(self, lists: list[list[str]]) -> None:
        """Learn what is new in these lists of chunks."""
        new = set().union(*lists).difference(self)
        if len(self) + len(new) > CACHE:
            self.clear()
            new = set().union(*lists)
        ended = [c for c in new if _ENDED(c)] if self.marks else []
        new.difference_update(ended)
        parts = {c[:-1] for c in ended} | {c[-1] for c in ended}
        if new := new | parts.difference(self):
            self.learn(list(new))
        for c in ended:
            (n, pairs, groups), (n2, pairs2, groups2) = self[c[:-1]], self[c[-1]]
            self[c] = (n + n2, pairs + pairs2, groups + b";" + groups2)

    def text(self, lists: Iterable[list[str]], known: bool = False) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """``n_a, n_b, n_groups, n_links, sha256, pairs, counts`` of a text cut into lists of chunks."""
        none = np.empty(0, np.uint32)
        n_a = n_b = n_groups = n_links = 0
        sha, pairs, counts = hashlib.sha256(), none, none
        k = -1
        for k, chunks in enumerate(lists):
            if not known:
                self.know([chunks])
            sizes, links, groups = zip(*map(self.__getitem__, chunks))
            groups = b";".join(groups)
            if _BAD in groups:
                return 0, 0, 0, 0, "", none, none
            sha.update(b";" + groups if k else groups)
            n = np.frombuffer(b"".join(sizes), "<u8")
            n_a += int(n[::2].sum())
            n_b += int(n[1::2].sum())
            n_groups += groups.count(b";") + 1
            links = np.frombuffer(b"".join(links), "<u4")
            n_links += len(links)
            pairs, counts = _merged(pairs, counts, *np.unique(links, return_counts=True))
        return n_a, n_b, n_groups, n_links, sha.hexdigest() if k >= 0 else "", pairs, counts

    def blocks(self, text: str | None) -> Iterator[list[str]]:
        """A text with its space in front as lists of chunks, of about ``_BLOCK`` characters each."""
        full, at = " " + text if text else "", 0
        while at < len(full):
            cut = _CUT.search(full, at + _BLOCK) if self.cuts else None
            end = cut.start() if cut else len(full)
            yield self.chunks(full[at:end])
            at = end


def _merged(pairs, counts, more, more_counts):
    if not len(pairs):
        return more, more_counts
    both, where = np.unique(np.concatenate((pairs, more)), return_inverse=True)
    total = np.zeros(len(both), np.int64)
    np.add.at(total, where, np.concatenate((counts, more_counts)))
    return both, total


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of two tokenizer files, one per Python worker."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def pack(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising distinct pairs and their counts: differences and counts, byte by byte, compressed."""
    both = np.concatenate((np.diff(pairs, prepend=np.uint32(0)), counts)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    both = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()
    n = len(both) // 2
    return np.cumsum(both[:n], dtype=np.uint32), both[n:].astype(np.int64)


# -- Spark -------------------------------------------------------------------

_ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each document, with its distinct id pairs and their numbers packed in ``pairs``."""
    def run(batches):
        al = aligner(a_path, b_path)
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                some, size = [], 0
                while at + len(some) < len(texts) and size < _BLOCK:
                    t = texts[at + len(some)] or ""
                    some.append(list(al.blocks(t)) if len(t) < _BLOCK else t)
                    size += len(t)
                al.know([c for x in some if isinstance(x, list) for c in x])
                rows = [al.text(x, True) if isinstance(x, list) else None for x in some]
                rows = [al.text(al.blocks(x)) if r is None else r for r, x in zip(rows, some)]  # long ones, block by block
                cols = list(zip(*[r[:5] for r in rows]))
                packed = [pack(r[5], r[6]) if len(r[5]) else None for r in rows]
                yield pa.record_batch([ids.slice(at, len(some)), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                                       pa.array(packed, pa.binary())],
                                      names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])
                at += len(some)

    return docs.select("doc_id", "text").mapInArrow(run, _ROW + ", pairs binary")


def pair_counts(rows: DataFrame, held: int = 1_000_000) -> DataFrame:
    """``pair, count, best``: how many links hold each id pair linked, and whether none of its B id's pairs has more."""
    def run(batches):
        def out(pairs, counts):
            return pa.record_batch([pa.array(pairs.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["pair", "n"])

        pairs, counts, parts, size = np.empty(0, np.uint32), np.empty(0, np.int64), [], 0
        for b in batches:
            parts += [unpack(x) for x in b.column(0).to_pylist()]
            size = sum(len(p) for p, _ in parts)
            if size > held:
                pairs, counts = _merged(pairs, counts, *_merged_all(parts))
                parts = []
                if len(pairs) > held:
                    yield out(pairs, counts)
                    pairs, counts = pairs[:0], counts[:0]
        if parts:
            pairs, counts = _merged(pairs, counts, *_merged_all(parts))
        if len(pairs):
            yield out(pairs, counts)

    total = saved(rows.filter("pairs IS NOT NULL").select("pairs").mapInArrow(run, "pair long, n long")
                  .groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(0xFFFF)), "align-counts")
    most = total.groupBy("b").agg(F.max("count").alias("most"))
    return saved(total.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "align-best")


def _merged_all(parts):
    both, where = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return both, np.bincount(where, np.concatenate([c for _, c in parts]), len(both)).astype(np.int64)


def _by_broadcast(rows: DataFrame, counts: DataFrame) -> DataFrame:
    found = counts.orderBy("pair").toArrow()
    held = rows.sparkSession.sparkContext.broadcast(tuple(found.column(c).to_numpy() for c in ("pair", "count", "best")))

    def run(batches):
        pair, count, best = held.value
        pair = pair.astype(np.uint32)
        for b in batches:
            n_best, total = [], []
            for x in b.column(6).to_pylist():
                if x is None:
                    n_best.append(0)
                    total.append(0)
                    continue
                pairs, n = unpack(x)
                at = np.searchsorted(pair, pairs)
                n_best.append(int(n[best[at]].sum()))
                total.append(int((n * count[at]).sum()))
            yield pa.record_batch([*b.columns[:6], pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=[*b.schema.names[:6], "n_best", "count_sum"])

    return rows.mapInArrow(run, _ROW + ", n_best long, count_sum long")


def _by_shuffle(rows: DataFrame, counts: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for row, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                pairs, n = unpack(x)
                yield pa.record_batch([pa.array(np.full(len(n), row)), pa.array(pairs.astype(np.int64)), pa.array(n)], names=["row", "pair", "n"])

    links = rows.filter("pairs IS NOT NULL").select("row", "pairs").mapInArrow(run, "row long, pair long, n long")
    sums = links.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
                                                         F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(sums, "row", "left").select(*rows.columns[:6], none("n_best"), none("count_sum"))


def aligned_tokens(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   limit: int = PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` for every row of ``docs``.

    ``a_path`` is a byte-level BPE file of the tokenizers library, ``b_path`` a
    sentencepiece model with byte fallback; every executor can read both."""
    python_ready(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = saved(aligned(docs, a_path or default_tokenizer(), b_path or default_pieces())
                 .withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = pair_counts(rows)
    return _by_broadcast(rows, counts) if counts.count() <= limit else _by_shuffle(rows, counts)
