"""SimHash near-duplicates by fuzzy hashing with the Golay code.

A document's fingerprint has 64 bits; fingerprints link at ``RADIUS`` = 3 or
fewer differing bits.  A fingerprint is cut into three segments of 22, 21 and
21 bits, each read as a word of the perfect binary Golay code [23, 12, 7].

* **Keys of a segment.**  Every word lies within 3 bits of exactly one
  codeword.  Words that differ in one bit either decode to the same codeword
  or both lie at distance 3 from theirs, and then each one's codeword is at
  distance 4 from the other word; five further codewords are that near.  So a
  word has 1 or 6 codeword indices of 12 bits, and of two words that differ in
  at most one bit the index of either is among the other's.
* **Pigeonhole.**  Three errors over three segments leave a segment without
  error beside one with at most one error, or one error in each.  The first
  case meets under (segment as it is, index of another segment): six ordered
  pairs, 34 bits and more.  The second meets under all three indices (36 bits);
  one side varies the second segment's index only and the other those of the
  first and third, so a fingerprint sends about 64 keys instead of 200.
* **Verification** counts differing bits.  Only components are wanted: equal
  keys meet in a task, which sends a spanning forest of the links among them,
  at most one edge a member in a large group, never all pairs.
* **Large groups.**  A key's group of more than ``GROUP`` fingerprints isn't
  held: its members go to an exact search that is linear in their number.  Two
  fingerprints link if and only if a 64-bit word lies within 1 bit of one and 2
  of the other; members are joined on those words, each word giving a star.

Equal fingerprints are one node, so copies are compared once.

Edge cases: null texts and texts without words have fingerprint zero and link
like any other; with fewer words than a shingle the whole sequence is one
shingle; long texts are read in blocks; repeated rows each get a row; a null id
gets a row, and the smallest id of its component that isn't null; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import python_ready, saved
from .components import components

RADIUS = 3
#: Generator polynomial of the Golay code.
GOLAY = 0b101011100011
#: Low bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a key's group that a task compares; larger ones take the exact search by words.
GROUP = 16_384
_PAIRS = 16               # groups of so many at most are compared pair by pair
_BLOCK = 1 << 20          # bytes of a text read at once
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_U = np.uint64


# -- fingerprints ------------------------------------------------------------

def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit ``hashes`` have each bit set."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little")
    lanes = np.zeros((-(-len(hashes) // 255), 255, 8), np.uint64)  # bytes that count up to 255 rows
    lanes.reshape(-1)[:len(hashes) * 8] = bits.view(np.uint64)
    return lanes.sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def _hashes(words: list[bytes], n: int, seed: int) -> np.ndarray:
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    h = xxhash.xxh64_intdigest
    first = (end - size)[:len(words) - n + 1].tolist()
    return np.array([h(joined[a:b], seed) for a, b in zip(first, end[n - 1:].tolist())], np.uint64)


def fingerprint(text: bytes | None, n: int = 3, seed: int = 42, block: int = _BLOCK) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    text, at, words, total = text or b"", 0, [], 0
    counts = np.zeros(64, np.int64)
    while at < len(text):
        cut = _SPACE.search(text, at + block)
        end = cut.start() if cut else len(text)
        words += text[at:end].lower().split()
        at = end
        if len(words) >= n:
            h = _hashes(words, n, seed)
            counts += bit_counts(h)
            total += len(h)
            words = words[len(words) - n + 1:]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(words), seed) if words else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fp`` by row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t, n, seed) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, fp long")


# -- keys --------------------------------------------------------------------

@functools.cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the high 12 bits, nearest error by syndrome, and by syndrome the change of the index to each key (-1: none)."""
    def remainder(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x

    high = np.array([remainder(i << 11) for i in range(1 << 12)])
    code = (np.arange(1 << 12) << 11) ^ high
    seven = code[np.bitwise_count(code) == 7]
    error = np.zeros(1 << 11, np.int64)
    change = np.full((1 << 11, 6), -1)
    one = [0] + [1 << i for i in range(23)]
    for e in {a | b | c for a in one for b in one for c in one}:
        s = (e & 2047) ^ int(high[e >> 11])
        error[s], change[s, 0] = e, 0
        if e.bit_count() == 3:
            change[s, 1:] = seven[(seven & e) == e] >> 11
    return high, error, change


def indices(words: np.ndarray) -> np.ndarray:
    """Codeword indices of 23-bit words, six a word, the own first, -1 where there are fewer."""
    high, error, change = golay()
    s = (words & 2047) ^ high[words >> 11]
    own = (words ^ error[s]) >> 11
    return np.where(change[s] >= 0, own[:, None] ^ change[s], -1)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of the fingerprints (uint64), with the place of each key's fingerprint."""
    segs = [((fps >> _U(lo)) & _U((1 << width) - 1)).astype(np.int64) for lo, width in SEGMENTS]
    ind = [indices(s) for s in segs]
    out, place = [], []

    def add(key: np.ndarray, good: np.ndarray) -> None:
        out.append(key[good])
        place.append(np.nonzero(good)[0])

    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                tag += 1
                add((tag << 40) | (segs[i][:, None] << 12) | ind[j], ind[j] >= 0)
    a, b, c = ind
    add((a[:, :1] << 24) | (b << 12) | c[:, :1], b >= 0)
    outer = (a[:, :, None] << 24) | (b[:, :1, None] << 12) | c[:, None, :]
    good = (a[:, :, None] >= 0) & (c[:, None, :] >= 0)
    good[:, 0, 0] = False  # sent already
    add(outer.reshape(len(fps), -1), good.reshape(len(fps), -1))
    return np.concatenate(out), np.concatenate(place)


# -- links -------------------------------------------------------------------

def forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    u, v = [], []
    left = fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                u.append(np.full(len(found), x))
                v.append(found)
                queue.extend(found)
    return (np.concatenate(u), np.concatenate(v)) if u else (fps[:0], fps[:0])


def _links_of(key: np.ndarray, fp: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links within whole groups of rows sorted by key and fingerprint, and the members of groups above ``group``."""
    fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])))
    key, fp = key[fresh], fp[fresh]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(start, len(key)))
    pairwise = min(_PAIRS, group)
    small = np.repeat(size <= pairwise, size)
    us, vs = [fp[:0]], [fp[:0]]
    for k in range(1, pairwise):
        at = np.flatnonzero((key[k:] == key[:-k]) & small[k:]) if len(key) > k else np.empty(0, np.int64)
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + k]) <= RADIUS]
        us.append(fp[at])
        vs.append(fp[at + k])
    for g in np.flatnonzero((size > pairwise) & (size <= group)):
        u, v = forest(fp[start[g]:start[g] + size[g]])
        us.append(u)
        vs.append(v)
    return np.concatenate(us), np.concatenate(vs), fp[np.repeat((size > group) & (size > 1), size)]


def links_by_key(nodes: DataFrame, group: int = GROUP) -> DataFrame:
    """``u, v``: links that keep the components of the fingerprints ``fp`` that meet under a key; ``v`` is null for members of groups above ``group``."""
    def send(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(fps), 4096):
                part = fps[lo:lo + 4096]
                key, at = keys(part)
                yield pa.record_batch([pa.array(key), pa.array(part[at].view(np.int64))], names=["key", "fp"])

    def meet(batches):
        held_key, held_fp, over = np.empty(0, np.int64), np.empty(0, np.uint64), None

        def out(u: np.ndarray, v: np.ndarray | None = None):
            far = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v.view(np.int64))
            return pa.record_batch([pa.array(u.view(np.int64)), far], names=["u", "v"])

        def whole(key: np.ndarray, fp: np.ndarray):
            u, v, large = _links_of(key, fp, group)
            yield out(u, v)
            yield out(large)

        for b in batches:
            if not b.num_rows:
                continue
            key = b.column(0).to_numpy(zero_copy_only=False)
            fp = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if over is not None:  # the rest of a group that isn't held
                n = int(np.searchsorted(key, over, "right"))
                yield out(fp[:n])
                key, fp = key[n:], fp[n:]
                if not len(key):
                    continue
                over = None
            key, fp = np.concatenate((held_key, key)), np.concatenate((held_fp, fp))
            cut = int(np.searchsorted(key, key[-1], "left"))
            if cut:
                yield from whole(key[:cut], fp[:cut])
            held_key, held_fp = key[cut:], fp[cut:]
            if len(held_key) > group:
                yield out(held_fp)
                over = int(held_key[0])
                held_key, held_fp = held_key[:0], held_fp[:0]
        if len(held_key):
            yield from whole(held_key, held_fp)

    rows = nodes.select("fp").mapInArrow(send, "key long, fp long")
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(meet, "u long, v long")


def _masks(most: int) -> np.ndarray:
    one = [0] + [1 << i for i in range(64)]
    found = set(one) if most == 1 else {a ^ b for a in one for b in one}
    return np.array(sorted(found), np.uint64).view(np.int64)


def links_by_word(nodes: DataFrame) -> DataFrame:
    """``u, v``: links that keep the components of the fingerprints ``fp``, by the words near them."""
    around = lambda most: nodes.select("fp", F.explode(F.lit(_masks(most))).alias("m")) \
        .select(F.col("fp").bitwiseXOR(F.col("m")).alias("word"), "fp")
    lead = around(1).groupBy("word").agg(F.min("fp").alias("lead"))
    return around(2).join(lead, "word").filter("fp != lead").select(F.col("fp").alias("u"), F.col("lead").alias("v")).distinct()


def simhash_components(docs: DataFrame, n: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
                       group: int = GROUP) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``; the
    component is named by the smallest ``doc_id`` that links reach."""
    python_ready(docs.sparkSession)
    rows = saved(fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), n, seed),
                 "sim-fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "sim-nodes")
    met = saved(links_by_key(nodes, group), "sim-links")
    links = met.filter("v IS NOT NULL")
    large = saved(met.filter("v IS NULL").select(F.col("u").alias("fp")).distinct(), "sim-large")
    if not large.isEmpty():
        links = links.unionByName(links_by_word(large))
    label = components(links)
    named = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = saved(named, "sim-named")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
