"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased and every run of characters other than letters and
digits becomes one space.  Each benchmark item is cut into windows of
``WINDOW`` characters that overlap by half (a shorter item is one window), and
besides into windows of ``SHORT`` characters that start so closely that every
run of ``PASSAGE`` characters of the item holds a whole one.  A window of ``m``
characters leaks when some region of a document lies within ``e`` edits of it:
``m // CHARS_PER_EDIT``, and for short windows the most that the bound below
allows, ``(m - q) // q``.  So every verbatim run of ``PASSAGE`` characters or
more is found, and every shorter item as a whole (under ``WHOLE`` characters
without edits).

By the q-gram lemma such a region shares at least ``m - q + 1 - q * e``
q-grams with the window, and their diagonals (place in the document minus place
in the window) spread over at most ``e + 1`` values.  So the diagonals are cut
into bands of ``2^z > e`` that overlap by ``e``, shared q-grams are counted by
(window, band), and only bands that meet the bound are verified by banded
alignment (dynamic programming over the band's diagonals, free at both ends of
the region).  The filter loses no match.

The benchmark is read in blocks of at most ``BLOCK_CHARS`` normalised
characters, each a bounded index that is broadcast; documents stream past it in
Arrow batches, whole and without a shuffle.  Batches are worked through in
pieces of bounded size, so memory depends neither on the longest document nor
on the number of hits.

Edge cases: null or empty texts and items match nothing; an item with fewer
than ``MIN_CHARS`` normalised characters (a q-gram) is no evidence and isn't
looked for (words as short as that occur in clean text); equal items are each reported;
repeated documents each get their rows; a null id is reported as null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import TEXT_BATCH, in_worker, python_ready, row_key, saved, within

Q = 12
WINDOW = 96
#: Least verbatim run that is always found, and the windows that find it.
PASSAGE = 60
SHORT = 50
CHARS_PER_EDIT = 16
MIN_CHARS = 12
#: Items under this many normalised characters are matched without edits.
WHOLE = 32
#: Normalised characters of one benchmark block (about 180 bytes of index for each).
BLOCK_CHARS = 2_000_000
#: Normalised characters of documents, and shared q-grams, worked on at once.
PIECE = 1_000_000
PAIRS = 4_000_000
#: Bands aligned at once.
BANDS = 10_000

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1
_TABLE = None


def _kinds() -> np.ndarray:
    """By code point: itself for letters, marks and digits, else a space."""
    global _TABLE
    if _TABLE is None:
        t = np.arange(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            if unicodedata.category(chr(i))[0] not in "LNM":
                t[i] = 32
        _TABLE = t
    return _TABLE


def normalise(text: str | None) -> np.ndarray:
    """Code points of the normalised text."""
    a = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = _kinds()[a]
    if not len(a):
        return a
    space = a == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    a = a[keep]
    return a[:-1] if len(a) and a[-1] == 32 else a


def grams(a: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q-gram of ``a``, by doubling."""
    out, have, done = None, 0, a.astype(np.uint64) + _U(0x51ED27)
    size, power = 1, _P
    n = len(a)
    with np.errstate(over="ignore"):
        while size <= q:
            if q & size:  # append this power of two on the right
                if out is None:
                    out, have = done, size
                else:
                    m = n - have - size + 1
                    out = out[:max(m, 0)] * _U(power) + done[have:have + max(m, 0)]
                    have += size
            if size * 2 <= q:
                m = max(n - 2 * size + 1, 0)
                done = done[:m] * _U(power) + done[size:size + m]
            power = power * power & _M
            size *= 2
        out = out[:max(n - q + 1, 0)]
        return out ^ (out >> _U(29))


def least_edits(a: np.ndarray, first: np.ndarray, windows: np.ndarray, width: int, e: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn a part of ``a`` into each of ``windows`` (rows of equal length), and the end of that part.

    Banded alignment of all rows at once: character ``i`` of window ``k`` meets
    places ``first[k] + i .. first[k] + i + width - 1``; both ends of the part
    are free.  Rows that need more than ``e`` edits get ``e + 1`` or more."""
    n, m = len(a), windows.shape[1]
    big = np.int32(m + e + 1)
    at = np.arange(width)
    near = np.clip(first, -m - width, n)  # bands beyond either end meet nothing
    pad = np.full(2 * (m + width) + 1, 0x110002, np.uint32)
    chars = np.concatenate((pad, a, pad))
    edits, ends = np.full(len(first), big), np.zeros(len(first), np.int64)
    left = np.arange(len(first))
    # cell b of row i: the first i characters of the window against a[..:first + i + b]
    end = near[:, None] + at
    row = np.where((end >= 0) & (end <= n), np.int32(0), big)
    for i in range(1, m + 1):
        end = near[left, None] + at + i
        out = (end < 0) | (end > n)
        new = row + (chars[end - 1 + len(pad)] != windows[left, i - 1][:, None])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        new[out] = big
        new = np.minimum.accumulate(new - at, axis=1) + at
        new[out] = big
        row = new
        if i % 8 == 0 or i == m:
            good = row.min(axis=1) <= e
            row, left = row[good], left[good]
            if not len(left):
                return edits, ends
    best = row.argmin(axis=1)
    edits[left] = row[np.arange(len(left)), best]
    ends[left] = near[left] + best + m
    return edits, ends


def within_edits(region: np.ndarray, window: np.ndarray, shift: int, width: int, e: int) -> tuple[int, int] | None:
    """``(edits, end)`` of ``least_edits`` for one window, if at most ``e``."""
    edits, ends = least_edits(region, np.array([shift]), window[None], width, e)
    return (int(edits[0]), int(ends[0])) if edits[0] <= e else None


class Index:
    """Q-grams of a block of benchmark items, by hash."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, window: int = WINDOW,
                 chars_per_edit: int = CHARS_PER_EDIT, min_chars: int = MIN_CHARS):
        self.q, self.windows = q, []
        short = min(SHORT, window)
        for item, text in items:
            a = normalise(text)
            if len(a) < max(min_chars, q):
                continue
            places = {(s, s + size) for size, step in ((window, window // 2), (short, PASSAGE - short + 1))
                      for s in (*range(0, len(a) - size, step), max(0, len(a) - size))}
            for s, t in sorted({(s, min(t, len(a))) for s, t in places}):
                w = a[s:t]
                e = min(len(w) // chars_per_edit, (len(w) - q) // q) if len(a) >= WHOLE else 0
                self.windows.append((item, w, e, len(w) - q + 1 - q * e))
        self.edits = np.array([w[2] for w in self.windows], np.int64)
        self.sizes = np.array([len(w[1]) for w in self.windows], np.int64)
        self.least = np.array([w[3] for w in self.windows], np.int64)
        z = 1
        while self.windows and 1 << z <= self.edits.max():
            z += 1
        self.z = z
        hashes = [grams(w[1], q) for w in self.windows]
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        win = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
        pos = np.concatenate([np.arange(len(x)) for x in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        h, self.win, self.pos = h[order], win[order], pos[order]
        self.hash, self.first = np.unique(h, return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.bits = max(16, int(np.ceil(np.log2(max(1, len(self.hash)) * 16))))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.hash >> _U(64 - self.bits)).astype(np.int64)] = True

    def candidates(self, a: np.ndarray):
        """``(window, band)`` pairs of the piece ``a`` that meet the q-gram bound, each with its lowest diagonal."""
        h = grams(a, self.q)
        maybe = np.flatnonzero(self.seen[(h >> _U(64 - self.bits)).astype(np.int64)])
        slot = np.searchsorted(self.hash, h[maybe])
        slot[slot == len(self.hash)] = 0
        good = self.hash[slot] == h[maybe]
        place, slot = maybe[good], slot[good]
        found, lo = [], 0
        total = np.cumsum(self.count[slot])
        overlap = int(self.edits.max())
        while lo < len(place):  # by pieces of at most PAIRS shared q-grams
            base = int(total[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, base + PAIRS, "right")))
            n = self.count[slot[lo:hi]]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            entry = np.repeat(self.first[slot[lo:hi]], n) + inner
            diag = np.repeat(place[lo:hi], n) - self.pos[entry] + (1 << 20)
            band = diag >> self.z
            twice = (diag & ((1 << self.z) - 1)) < overlap
            win = np.concatenate((self.win[entry], self.win[entry][twice]))
            band = np.concatenate((band, band[twice] - 1))
            key, c = np.unique(win * (1 << 40) + band, return_counts=True)
            found.append((key, c))
            lo = hi
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(found) > 1:  # a band's q-grams may lie in two pieces
            key, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            c = np.bincount(back, np.concatenate([c for _, c in found])).astype(np.int64)
        else:
            key, c = found[0]
        win, band = key >> 40, key & ((1 << 40) - 1)
        ok = c >= self.least[win]
        return win[ok], (band[ok] << self.z) - (1 << 20)

    def matches(self, a: np.ndarray):
        """``(window, start, end, edits)`` of verified regions of ``a`` (start is a lower bound within ``e``)."""
        if not len(self.hash):
            return
        wins, lows = self.candidates(a)
        size = self.sizes[wins]
        for m, e in {(len(w[1]), w[2]) for w in self.windows}:
            of = np.flatnonzero((size == m) & (self.edits[wins] == e))
            for lo in range(0, len(of), BANDS):
                win, low = wins[of[lo:lo + BANDS]], lows[of[lo:lo + BANDS]]
                edits, end = least_edits(a, low - e, np.stack([self.windows[k][1] for k in win.tolist()]), (1 << self.z) + 3 * e, e)
                ok = edits <= e
                start = np.maximum(np.maximum(low - e, 0), end - m)
                yield from zip(win[ok].tolist(), start[ok].tolist(), end[ok].tolist(), edits[ok].tolist())


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", q: int = Q, window: int = WINDOW,
          chars_per_edit: int = CHARS_PER_EDIT, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, n_windows, edits, start, end``: a row per document and item that leak.

    ``n_windows`` counts the item's windows found, ``edits`` is the least of
    their edit distances, ``start`` and ``end`` bound what was found, in the
    normalised text."""
    spark = docs.sparkSession
    python_ready(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = saved(benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("t"))
                  .filter(F.length("t") > 0), "dec-items")
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_chars))
    out = None
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == k).orderBy("item", "t").collect()
        part = _scan(docs, [(r.item, r.t) for r in block], q, window, chars_per_edit, min_chars)
        part = saved(part, "dec-block") if blocks > 1 else part
        out = part if out is None else out.unionByName(part)
    return out


def _scan(docs: DataFrame, items: list[tuple[int, str]], q: int, window: int, chars_per_edit: int, min_chars: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(items)

    def piece(rows, index: Index):
        """Leaks of some documents: normalised texts one after the other with gaps that no q-gram spans."""
        gap = np.full(2 * window, 0x110001, np.uint32)
        starts, parts, n = [], [], 0
        for _, a in rows:
            starts.append(n)
            parts += [a, gap]
            n += len(a) + len(gap)
        best: dict[tuple[int, int], list] = {}
        for win, s, t, edits in index.matches(np.concatenate(parts)):
            d = int(np.searchsorted(starts, s, "right")) - 1
            s, t = s - starts[d], t - starts[d]
            got = best.setdefault((d, index.windows[win][0]), [set(), edits, s, t])
            got[0].add(win)
            got[1], got[2], got[3] = min(got[1], edits), min(got[2], s), max(got[3], t)
        return [(rows[d][0], item, len(g[0]), g[1], g[2], g[3]) for (d, item), g in best.items()]

    def run(batches):
        index = Index(held.value, q, window, chars_per_edit, min_chars)
        for b in batches:
            rows, size, out = [], 0, []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a = normalise(text)
                if len(a) >= min_chars // 2:
                    rows.append((doc, a))
                    size += len(a)
                if size >= PIECE:
                    out += piece(rows, index)
                    rows, size = [], 0
            if rows:
                out += piece(rows, index)
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                                  names=["doc_id", "item_id", "n_windows", "edits", "start", "end"])

    return docs.mapInArrow(in_worker("decontaminate", run), "doc_id long, item_id long, n_windows long, edits long, start long, end long")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without the rows that leak; all columns stay.

    Rows are judged by id and text, so a leak says nothing of another text under the same or a null id."""
    keyed = docs.withColumn("_key", row_key(F.col(id_col), F.col(text_col)))
    found = leaks(keyed, benchmark, id_col="_key", text_col=text_col, **params)
    found = saved(found.select(F.col("doc_id").alias("_leak")).distinct(), "dec-found", TEXT_BATCH)
    return keyed.join(within(found), F.col("_key") == F.col("_leak"), "left_anti").drop("_key")
