"""N-gram Jaccard self-join by parity sketches, and its connected components.

A document is the set of its distinct word shingles, each a 64-bit hash.  Two
sets of sizes ``s1 <= s2`` with Jaccard similarity of ``t`` or more have
``s1 >= t * s2`` and a symmetric difference of at most
``(s1 + s2) * (1 - t) / (1 + t)``.

* **Size bands.**  Band ``j`` holds the sizes ``L .. U = floor(L / t)``, so the
  partners of a set lie in its own band or a neighbouring one.  A set sends
  keys to the scheme of its own band and to that of the next larger band; any
  pair that can link meets in the scheme of its larger member.
* **Parity sketches.**  In scheme ``j`` the shingles are dealt to ``k`` blocks
  by hash, and every shingle flips one of 2^32 bits of its block.  The Hamming
  distance of two sketches never exceeds the symmetric difference ``d`` of the
  sets.  A block's sparse bit vector travels as the XOR of one 64-bit code per
  set bit, so equal blocks have equal codes.
* **Pigeonhole.**  With ``k = d_max + 1 + s`` blocks a linking pair agrees on
  ``s + 1`` blocks at least.  A set may therefore leave out up to ``s`` blocks
  of at most one shingle: what makes a block poor is its content, which both
  members share, so one common block is sent by both.
* **Verification.**  Candidates must pass the size test and the Hamming test on
  a dense parity sketch of 1,024 bits, or as many as the set's size rounded up to
  a power of two; the rest are verified on the whole texts.

Only the components are wanted, so a key's group isn't expanded into pairs.
Each member is compared with the group's first one.  Members that still lie in
another component than the first are compared by sketch with the group's other
members, whole groups at a time in NumPy (``near_pairs``).  ``FORESTS`` rounds
yield a spanning forest of the near pairs only, whose verified links join most
of what belongs together; the last one yields all near pairs between components that are
left.  Then every pair that
shares a key has been compared or is connected already, so no link that would
join two components is lost.  Exact copies share one node (the fingerprint of
the set) and aren't compared at all.

Fingerprints have 64 bits: among N distinct sets the chance that any two
collide is below N^2 / 2^65.

Edge cases: a null or blank text has 0 shingles and is a component of its own;
a text of fewer than ``n`` words is one shingle; repeated rows each get a row;
a null id gets a row, and the smallest id of its component that isn't null;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import TEXT_BATCH, in_worker, python_ready, saved, within
from .components import components

_WORDS = 50_000           # bound of the word-hash cache where texts are compared one by one
_SLICE = 1 << 20          # bytes of text that are hashed at once; a task holds some twenty times as much meanwhile
_LONG = 64                # longer words are hashed one by one
_SKETCH = 1024            # least bits of the dense sketch
FORESTS = 1               # rounds that yield a spanning forest of near pairs, before the one that yields them all
_DEAL = 4_096             # members of a group for each part that its open members are dealt to
_TILE = 1 << 14           # pairs compared at once
_PART = 1 << 20           # keys that a task sorts
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_M = (1 << 64) - 1
_IN_WORD = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first k bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over a uint64 array."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _mix(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


class WordHash(dict):
    """64-bit hash by word, as ``word_hashes`` gives it; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        if len(word) > _LONG:
            h = xxhash.xxh3_64_intdigest(word)
        else:
            h = _mix(len(word))
            for i in range(0, len(word), 8):
                h = _mix(h ^ int.from_bytes(word[i:i + 8], "little"))
        self[word] = h
        return h


def word_hashes(text: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``text[first:first + size]``, eight bytes a step."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(text) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from each place on
    h = mix(size.astype(np.uint64))
    left = np.flatnonzero(size <= _LONG)
    for done in range(0, _LONG, 8):
        left = left[size[left] > done]
        if not len(left):
            break
        h[left] = mix(h[left] ^ (eight[first[left] + done] & _BYTES[np.minimum(size[left] - done, 8)]))
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(text[first[i]:first[i] + size[i]])
    return h


def shingles(text: str | None, n: int, words: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of ``text``.

    A-Z are lower-cased and words are runs other than U+0020 and U+0009 to
    U+000D (what ``bytes.split`` does)."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    m = min(n, len(h))
    return np.unique(_folded(h, np.arange(len(h) - m + 1), m))


def _folded(h: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """Hashes of the runs of ``m`` words from the places ``at`` on."""
    acc = h[at]
    for i in range(1, m):
        acc = acc * _P + h[at + i]
    return mix(acc + _U(m))


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all runs ``first .. first + size - 1``, one run after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def shingle_sets(texts: pa.Array, n: int):
    """``shingles`` of all texts of an Arrow column, slice by slice: ``(first text, sets, bounds)``.

    The set of a slice's ``i``-th text is ``sets[bounds[i]:bounds[i + 1]]``."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(places, places[lo] + _SLICE, "right")) - 1)
        yield lo, *_slice_sets(data[places[lo]:places[hi]], places[lo:hi + 1] - places[lo], n)
        lo = hi


def _slice_sets(data: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    inside = _IN_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = places[(places > 0) & (places < len(data))]  # words end with their text
    begins[edge], ends[edge - 1] = inside[edge], inside[edge - 1]
    first = np.flatnonzero(begins)
    h = word_hashes(_LOWER[data], first, np.flatnonzero(ends) + 1 - first)
    word = np.searchsorted(first, places)
    n_words = np.diff(word)
    size = np.where(n_words < n, np.minimum(n_words, 1), n_words - n + 1)
    bounds = np.concatenate(([0], np.cumsum(size)))
    sets = np.empty(bounds[-1], np.uint64)
    full = n_words >= n
    sets[np.repeat(full, size)] = _folded(h, _runs(word[:-1][full], size[full]), n)
    for m in np.unique(n_words[(n_words > 0) & ~full]).tolist():
        short = np.flatnonzero(n_words == m)
        sets[bounds[short]] = _folded(h, word[short], m)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        sets[a:b].sort()
    new = np.ones(len(sets), bool)
    new[1:] = sets[1:] != sets[:-1]
    new[bounds[:-1][size > 0]] = True
    return sets[new], np.concatenate(([0], np.cumsum(new)))[bounds]


class Scheme:
    """Size bands and block counts for similarity ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(self.low[-1] * den // num + 1)
        self.starts = np.array(self.low)

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def blocks(self, band: int) -> tuple[int, int, int]:
        """``k, s, d_max`` of a band's scheme."""
        upper = self.low[band + 1] - 1
        d = 2 * upper * (self.den - self.num) // (self.den + self.num)
        s = d // 8
        return d + 1 + s, s, d

    def about(self, sets: DataFrame) -> int:
        """The number of join keys, or somewhat more, of sets of ``n_shingles`` each: their blocks in two schemes."""
        share = 2 * (self.den - self.num) / (self.den + self.num) * 9 / 8
        return math.ceil(sets.agg(F.sum(F.col("n_shingles") * share * (1 + self.den / self.num) + 4)).first()[0] or 0)

    def keys(self, sh: np.ndarray) -> np.ndarray:
        """The join keys of a set: of its own band's scheme and of the next."""
        return self.keys_of(sh, np.array([0, len(sh)]))[0]

    def keys_of(self, sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The join keys of several sets that aren't empty, one set after the other, and how many each has.

        All blocks of the sets' two schemes stand in one array of cells."""
        size = np.diff(bounds)
        own = np.searchsorted(self.starts, size, "right") - 1
        band = np.stack((own, own + 1), 1).ravel()
        known = {b: self.blocks(b) for b in np.unique(band).tolist()}
        k, s, d = np.array([known[b] for b in band.tolist()], np.int64).reshape(-1, 3).T
        k = np.where(d > 0, k, 0)  # no keys: equal sets only
        base = np.cumsum(k) - k
        acc, held = np.zeros(int(k.sum()), np.uint64), np.zeros(int(k.sum()), np.int64)
        code = mix((sets & _U(0xFFFFFFFF)) + _P)
        for scheme in (0, 1):
            blocks, start = np.repeat(k[scheme::2], size), np.repeat(base[scheme::2], size)
            cell = start + (((sets >> _U(32)) * blocks.astype(np.uint64)) >> _U(32)).astype(np.int64)  # rises with the sorted hashes
            used, each = blocks > 0, code
            if not used.all():
                cell, each = cell[used], code[used]
            if len(cell):
                first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
                acc[cell[first]] = np.bitwise_xor.reduceat(each, first)
                held[cell[first]] = np.diff(np.append(first, len(cell)))
        of = np.repeat(np.arange(len(k)), k)
        empty = np.bincount(of[held == 0], minlength=len(k))
        poor = empty + np.bincount(of[held == 1], minlength=len(k)) <= s
        sent = np.where(held == 0, ((empty > s) & ~poor)[of], (held > 1) | ~poor[of])
        of = of[sent]
        at = np.flatnonzero(sent) - base[of]
        keys = mix(acc[sent] ^ mix(at.astype(np.uint64) + (band[of].astype(np.uint64) << _U(40)) + _U(1)))
        return keys, np.bincount(of // 2, minlength=len(size))


def _node(sh: np.ndarray) -> int:
    return int(_nodes(sh, np.array([0, len(sh)]))[0])


def _nodes(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprints of sets that aren't empty."""
    first = bounds[:-1]
    return mix(np.bitwise_xor.reduceat(sets, first) + np.add.reduceat(mix(sets + _P), first) * _P
               + np.diff(bounds).astype(np.uint64)).view(np.int64)


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Bits of the dense sketch of a set, as a power of two that doesn't fall behind its size, as a full sketch tells nothing."""
    return np.maximum(_SKETCH.bit_length() - 1, np.frexp((size - 1).astype(float))[1])


def _sketches(sets: np.ndarray, size: np.ndarray, power: np.ndarray, empty: np.ndarray) -> pa.Array:
    """Sketches of ``2 ** power`` bits, of sets of ``size`` hashes each; null where ``empty``."""
    bits = np.where(empty, 0, 1 << power)
    ends = np.cumsum(bits)
    if empty.any():
        sets = sets[np.repeat(~empty, size)]
    size = np.where(empty, 0, size)
    at = np.repeat(ends - bits, size) + (mix(sets + _U(1)) >> np.repeat(64 - power, size).astype(np.uint64)).astype(np.int64)
    words = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends // 64)), pa.int32()), pa.array(words), mask=pa.array(empty))


def _signed(batches, n: int):
    """Signatures of ``doc_id, text, mark``."""
    for b in batches:
        for lo, sets, bounds in shingle_sets(b.column(1), n):
            size = np.diff(bounds)
            blank = size == 0
            node = np.zeros(len(size), np.int64)
            if not blank.all():
                node[~blank] = _nodes(sets, np.append(bounds[:-1][~blank], bounds[-1]))
            power = sketch_bits(size)
            half = blank | (1 << power <= _SKETCH)
            rows = b.slice(lo, len(size))
            yield pa.record_batch([rows.column(0), rows.column(2), pa.array(size, pa.int64()), pa.array(node, mask=blank),
                                   _sketches(sets, size, power, blank), _sketches(sets, size, power - 1, half)],
                                  names=["doc_id", "mark", "n_shingles", "node", "sketch", "half"])


def _keyed(batches, n: int, scheme: Scheme):
    """``key, node`` of ``doc_id, text``."""
    for b in batches:
        for _, sets, bounds in shingle_sets(b.column(1), n):
            bounds = np.append(bounds[:-1][np.diff(bounds) > 0], bounds[-1])
            if len(bounds) > 1:
                keys, each = scheme.keys_of(sets, bounds)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(np.repeat(_nodes(sets, bounds), each))], names=["key", "node"])


def _dealt(batches, parts: int):
    """``part, keys, nodes`` of ``key, node``: of each batch the keys that fall into a part, and their nodes, as arrays of 64-bit numbers."""
    for b in batches:
        key, node = b.column(0).to_numpy(), b.column(1).to_numpy()
        part = ((key.view(np.uint64) >> _U(32)) * _U(parts) >> _U(32)).astype(np.int32)
        order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
        count = np.bincount(part, minlength=parts)
        some = np.flatnonzero(count)
        places = pa.py_buffer(np.concatenate(([0], 8 * np.cumsum(count[some]))).astype(np.int32))
        both = [pa.Array.from_buffers(pa.binary(), len(some), [None, places, pa.py_buffer(x[order])]) for x in (key, node)]
        yield pa.record_batch([pa.array(some.astype(np.int32)), *both], names=["part", "keys", "nodes"])


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, mark, n_shingles, node, sketch, half`` by row; node and sketch are null for empty sets.

    ``mark`` is a hash of the text, never null; ``half`` is the sketch with
    half as many bits, null if that were fewer than ``_SKETCH``."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")) \
        .mapInArrow(in_worker("jaccard", lambda batches: _signed(batches, n)), "doc_id long, mark long, n_shingles long, node long, sketch array<long>, half array<long>")


def block_keys(docs: DataFrame, n: int, scheme: Scheme, parts: int) -> DataFrame:
    """``part, keys, nodes``: a key and its node per parity block that a document sends, many in a row; a key has one part of ``parts``."""
    return docs.select("doc_id", "text").mapInArrow(in_worker("jaccard", lambda batches: _dealt(_keyed(batches, n, scheme), parts)), "part int, keys binary, nodes binary")


def _grouped(batches):
    """``key, node, size, first, place`` of the keys of whole parts."""
    held = [[b"".join(b.column(i).to_pylist()) for i in (1, 2)] for b in batches if b.num_rows]
    if not held:
        return
    key, node = (np.frombuffer(b"".join(h[i] for h in held), np.int64) for i in (0, 1))
    held.clear()
    order = np.argsort(key)
    key, node = key[order], node[order]
    same = np.concatenate(([False], key[1:] == key[:-1], [False]))
    shared = same[1:] | same[:-1]  # few keys come twice, and only those are sorted by node
    key, node = key[shared], node[shared]
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))[:len(key)]
    key, node = key[new], node[new]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[:len(key)])
    size = np.diff(np.append(first, len(key)))
    place = np.arange(len(key)) - np.repeat(first, size) + 1
    low, size = np.repeat(node[first], size), np.repeat(size, size)
    for lo in range(0, len(key), 50_000):
        rows = lo + np.flatnonzero(size[lo:lo + 50_000] > 1)
        yield pa.record_batch([pa.array(c[rows]) for c in (key, node, size, low)] + [pa.array(place[rows], pa.int32())],
                              names=["key", "node", "size", "first", "place"])


def groups(docs: DataFrame, n: int, scheme: Scheme, rows: int) -> DataFrame:
    """``key, node, size, first, place`` for keys shared by two nodes or more; there are about ``rows`` keys.

    Most keys are a single node's, so a part of ``_PART`` keys is sorted as an
    array and only what is shared goes on."""
    parts = max(1, -(-rows // _PART))
    return block_keys(docs, n, scheme, parts).repartitionById(parts, "part") \
        .mapInArrow(in_worker("jaccard", _grouped), "key long, node long, size long, first long, place int")


def _near(a: str, b: str, num: int, den: int):
    """Size test, and the Hamming distance of the dense sketches with its test, of sides with columns ``n``, ``s`` and ``h``.

    Sets that pass the size test have sketches of equal length, or one has
    twice the bits and gives its half."""
    na, nb, sa, sb = F.col(f"n{a}"), F.col(f"n{b}"), F.col(f"s{a}"), F.col(f"s{b}")
    x = F.when(F.size(sa) > F.size(sb), F.col(f"h{a}")).otherwise(sa)
    y = F.when(F.size(sb) > F.size(sa), F.col(f"h{b}")).otherwise(sb)
    words = _SKETCH // 64
    short = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(words)), F.lit(0))
    long = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, n: t + n)
    far = F.when(F.size(x) == words, short).otherwise(long)
    sized = den * F.least(na, nb) >= num * F.greatest(na, nb)
    return F.when(sized, far * (den + num) <= (na + nb) * (den - num)).otherwise(False), far


def _side(nodes: DataFrame, x: str) -> DataFrame:
    return nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("half").alias(f"h{x}"))


def near_by_sketch(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Of the node pairs ``(a, b)`` those that may link by size and Hamming distance, with it as ``far``."""
    test, far = _near("a", "b", num, den)
    return pairs.join(_side(nodes, "a"), "a").join(_side(nodes, "b"), "b").filter(test).select("a", "b", far.alias("far"))


def near_pairs(batches, num: int, den: int, every: bool):
    """Near pairs ``(a, b)`` of rows ``key, part, node, label, n, s, h, open`` that come sorted by key and part.

    In each group (key and part) the rows that are ``open`` meet all others;
    near pairs of different labels are given, or with ``every`` false a
    spanning forest of them, the nearest of a tile first."""
    held = []
    for b in batches:
        if not b.num_rows:
            continue
        keys, parts = b.column(0).to_numpy(), b.column(1).to_numpy()
        cut = int(np.argmax((keys == keys[-1]) & (parts == parts[-1])))  # the last group may go on in the next batch
        if not cut and held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (keys[0], parts[0]):
            yield _near_in(held, num, den, every)
            held = []
        elif cut:
            yield _near_in([*held, b.slice(0, cut)], num, den, every)
            held = []
        held.append(b.slice(cut))
    if held:
        yield _near_in(held, num, den, every)


def _near_in(batches: list, num: int, den: int, every: bool) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches).combine_chunks()
    key, part, node, label, n = (t.column(i).to_numpy() for i in range(5))
    words, flat = [], []
    for i in (5, 6):  # sketches, and behind them their halves
        column = t.column(i).combine_chunks()
        words.append(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        flat.append(column.flatten().to_numpy())
    start = [np.cumsum(words[0]) - words[0], len(flat[0]) + np.cumsum(words[1]) - words[1]]
    words, flat = words[0], np.concatenate(flat).view(np.uint64)  # bits of signed numbers would be counted without the sign
    open_ = t.column(7).to_numpy()
    new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]))))
    group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(key))))
    _, code = np.unique(label, return_inverse=True)
    root = np.arange(len(code))  # of a label, by its code

    def far(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hamming distances; 0 where no sketches of one length are there."""
        w = np.minimum(words[i], words[j])
        out = np.zeros(len(i), np.int64)
        at = [np.where(words[x] == w, start[0][x], start[1][x]) for x in (i, j)]
        fits = np.maximum(words[i], words[j]) <= 2 * w
        for size in np.unique(w[fits]).tolist():
            of = np.flatnonzero(fits & (w == size))
            step = max(1, (_TILE << 4) // size)
            for lo in range(0, len(of), step):
                k = of[lo:lo + step]
                x, y = (flat[p[k][:, None] + np.arange(size)] for p in at)
                out[k] = np.bitwise_count(x ^ y).sum(1)
        return out

    found = []
    left = np.flatnonzero(open_)
    size = np.bincount(group)[group[left]]
    total, lo = np.cumsum(size), 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] - size[lo] + _TILE, "right")))
        i, j = np.repeat(left[lo:hi], size[lo:hi]), _runs(new[group[left[lo:hi]]], size[lo:hi])
        ok = (root[code[i]] != root[code[j]]) & (~open_[j] | (j < i)) & (den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j]))
        i, j = i[ok], j[ok]
        d = far(i, j)
        ok = np.flatnonzero(d * (den + num) <= (n[i] + n[j]) * (den - num))
        if not every:
            ok = ok[np.argsort(d[ok], kind="stable")]
            joined = []
            for k, x, y in zip(ok.tolist(), code[i[ok]].tolist(), code[j[ok]].tolist()):
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    joined.append(k)
            ok = np.array(joined, np.int64)
            while joined and (root != root[root]).any():
                root = root[root]
        found.append((node[i[ok]], node[j[ok]]))
        lo = hi
    a, b = (np.concatenate([f[s] for f in found] or [np.empty(0, np.int64)]) for s in (0, 1))
    return pa.record_batch([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Of the node pairs ``(a, b)`` those whose sets reach the similarity, compared on whole texts."""
    used = saved(pairs.select("a").union(pairs.select("b")).distinct()
                 .join(nodes.select(F.col("node").alias("a"), "rep"), "a")
                 .select(F.col("a").alias("node"), F.col("rep.doc_id").alias("_id"), F.col("rep.mark").alias("_mark")), "jac-used")
    # A null id counts as an id; of rows equal in id and text one is taken.
    texts = docs.join(within(used), docs.doc_id.eqNullSafe(used._id) & (F.xxhash64(docs.text) == used._mark)) \
        .select("node", "text").dropDuplicates(["node"])
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a") \
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        words, seen = WordHash(), {}
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ok = []
            for i, (ta, tb) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if (hub := seen.get(b[i])) is None:
                    hub = shingles(tb, n, words)
                    if _node(hub) != b[i]:  # another text with an equal hash
                        ok.append(False)
                        continue
                    if len(seen) >= 64:
                        seen.clear()
                    seen[b[i]] = hub
                x = shingles(ta, n, words)
                common = len(np.intersect1d(x, hub, assume_unique=True))
                ok.append(den * common >= num * (len(x) + len(hub) - common) and _node(x) == a[i])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(in_worker("jaccard", run), "a long, b long")


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Documents link at ``den * |intersection| >= num * |union|``; the component
    is named by the smallest ``doc_id`` that links reach."""
    if not 0 < num <= den:
        raise ValueError("the similarity must lie in (0, 1]")
    python_ready(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scheme = Scheme(num, den)
    sig = saved(signatures(docs, n), "jac-signatures", TEXT_BATCH)
    nodes = saved(sig.filter("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("half").alias("half")), "jac-nodes")
    met = saved(groups(docs, n, scheme, scheme.about(sig)), "jac-groups", _SLICE)

    state = {"labels": None}

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose ends lie in different components so far."""
        if state["labels"] is None:
            return pairs
        lab = lambda x: state["labels"].select(F.col("node").alias(x), F.col("label").alias(f"l{x}"))
        return pairs.join(lab("a"), "a", "left").join(lab("b"), "b", "left") \
            .filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb")

    def link(pairs: DataFrame) -> None:
        """Verify the candidate pairs; the links join components."""
        new = saved(verified(pairs.select("a", "b"), nodes, docs, n, num, den), "jac-links", TEXT_BATCH)
        if new.isEmpty():
            return
        old = state["labels"]
        if old is None:
            state["labels"] = components(new.select(F.col("a").alias("u"), F.col("b").alias("v")))
            return
        lab = lambda x: old.select(F.col("node").alias(x), F.col("label").alias(f"l{x}"))
        joined = components(new.join(lab("a"), "a", "left").join(lab("b"), "b", "left")
                            .select(F.coalesce("la", "a").alias("u"), F.coalesce("lb", "b").alias("v")))
        moved = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))  # labels are nodes of their components
        state["labels"] = saved(old.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
                                .union(joined.join(old, "node", "left_anti").select("node", "label")), "jac-labels")

    firsts = saved(met.filter("place > 1").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "jac-firsts")
    close = saved(near_by_sketch(firsts, nodes, num, den), "jac-close")
    # Of several first members take the nearest; most of the others then lie in the same component.
    best = close.groupBy("a").agg(F.min(F.struct("far", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    link(saved(best, "jac-best"))
    rest = saved(apart(close.join(best, ["a", "b"], "left_anti")), "jac-rest")
    if not rest.isEmpty():
        link(rest)

    # Members that aren't in the component of their group's first member meet the group's other members.
    wide = met.filter("size > 2 AND place > 1").select("key", "node", "first", F.ceil(F.col("size") / _DEAL).cast("int").alias("parts"))
    for turn in range(0 if wide.isEmpty() else FORESTS + 1):
        open_pairs = saved(apart(firsts), "jac-open")
        rows = wide.join(within(open_pairs), (F.col("node") == F.col("a")) & (F.col("first") == F.col("b")), "left") \
            .withColumn("open", F.col("a").isNotNull()).withColumn("any", F.max("open").over(W.partitionBy("key"))).filter("any")
        # The open members of a large group are dealt to parts, each of which gets all members.
        rows = rows.select("key", "node", "parts", "open", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")) \
            .withColumn("open", F.col("open") & (F.pmod(F.xxhash64("node"), "parts") == F.col("part")))
        if state["labels"] is not None:
            rows = rows.join(state["labels"], "node", "left")
        else:
            rows = rows.withColumn("label", F.col("node"))
        rows = rows.join(nodes, "node").select("key", "part", "node", F.coalesce("label", "node").alias("label"), F.col("n_shingles").alias("n"),
                                               F.col("sketch").alias("s"), F.col("half").alias("h"), "open") \
            .repartition("key", "part").sortWithinPartitions("key", "part", F.xxhash64("node", F.lit(turn)))
        every = turn == FORESTS
        near = rows.mapInArrow(in_worker("jaccard", lambda batches, every=every: near_pairs(batches, num, den, every)), "a long, b long")
        near = saved(near.distinct(), "jac-near")
        if near.isEmpty():
            break
        link(near)

    out = sig.select("doc_id", "n_shingles", "node")
    label = F.col("node")
    if state["labels"] is not None:
        out = out.join(state["labels"], "node", "left")
        label = F.coalesce("label", "node")
    out = saved(out.withColumn("label", label).select("doc_id", "n_shingles", "label"), "jac-labelled")
    least = out.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return out.join(least, "label", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
