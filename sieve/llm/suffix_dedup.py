"""Repeated-substring removal with a logarithmic family of sampled suffix arrays.

Every string of ``length`` bytes that also starts earlier in the corpus is
removed (all bytes it covers), judged on the input.

* **Sampled suffixes.**  Of the 32-byte grams inside a string of ``length``
  bytes the one with the least hash (the leftmost of equals) is its anchor, so
  equal strings have equal anchors.  Only suffixes at anchors are indexed: about
  one in 35 bytes instead of every byte.  All strings with one anchor place form
  one entry: consecutive starts that share the context around the anchor.
* **Arrays.**  A batch's array is the table of its entries in order of the
  suffix's first 32 bytes and then of its whole context, both by 64-bit hash:
  any fixed order that puts equal prefixes side by side serves a merge.
* **Family.**  Batches come in order of document id.  A new batch is sorted
  together with the existing levels in one merge scan.  An entry whose context
  stands before it, in a level or in the batch, repeats as a whole.  What is new
  becomes a level, and levels of equal size merge, so there are at most
  logarithmically many.
* **Long matches of part of a context.**  Where one 32-byte prefix has several
  contexts, only some of an entry's strings may repeat (the ends of a passage,
  the places around an edit).  A string holds 34 more bytes at least on one side
  of its anchor, so such an entry must first share that longer match with
  another; only then are the strings of that side hashed one by one from the
  text, and all but the first of equal hashes repeat.
* **Removal.**  Repeated strings are merged into byte runs by document, and the
  rest of each text is hashed.

Nothing is collected or grouped beyond one document; a passage that many
documents share is many entries, not one, and sorted groups spill.  Equality is
that of 64-bit hashes of the strings.

Edge cases: null counts as empty; texts under ``length`` bytes keep everything;
rows with a null id come before all others; rows with one id and different
texts are documents of their own in order of a text hash, rows equal in id and
text are one document and each get its result; other columns are ignored; an
empty table gives an empty result; very long texts are cut into overlapping
pieces for the anchors only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import BROADCAST_IDS, python_ready, saved

GRAM = 32
#: Bits of a place inside a piece; pieces start at every half of that.
BITS = 20
_NULL = -(1 << 63)
_U = np.uint64


def _table() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _BYTES = _table()


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes side by side."""
    x = left * _U(0xD6E8FEB86659FD93)
    x += right
    x ^= x >> _U(31)
    x *= _U(0xA0761D6478BD642F)
    x ^= x >> _U(29)
    return x


def string_hashes(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 32-byte grams and of all strings of ``length`` bytes of ``b``."""
    x, s = _BYTES[b], 1
    while s < GRAM:
        x = _join(x[:-s], x[s:])
        s *= 2
    grams = x
    x = _join(x[:-GRAM], x[GRAM:])
    n = len(b) - length + 1
    return grams, _join(x[:n], x[length - 2 * GRAM:length - 2 * GRAM + n])


def entries(b: np.ndarray, length: int):
    """``key, ctx, start, n, off`` of the entries of one text: ``n`` strings from ``start`` on share the anchor at ``start + off``."""
    half = 1 << (BITS - 1)
    out = []
    for lo in range(0, max(0, len(b) - length + 1), half):
        piece = b[lo:lo + half + length - 1]
        grams, strings = string_hashes(piece, length)
        low = (grams >> _U(BITS) << _U(BITS)) | np.arange(len(grams), dtype=np.uint64)
        width, s = length - GRAM + 1, 1
        while 2 * s <= width:
            low = np.minimum(low[:-s], low[s:])
            s *= 2
        n = len(strings)
        low = np.minimum(low[:n], low[width - s:width - s + n])
        anchor = (low & _U((1 << BITS) - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        count = np.diff(np.append(start, n))
        ctx = _join(_join(strings[start], strings[start + count - 1]), count.astype(np.uint64))
        out.append((grams[anchor[start]].view(np.int64), ctx.view(np.int64), start + lo, count, anchor[start] - start))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5


def _pack(start, n, off):
    return (start * 128 + n - 1) * 128 + off


def _bytes(text) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def index_entries(docs: DataFrame, length: int) -> DataFrame:
    """``key, ctx, doc, nr, at`` of ``docs (doc, nr, text)``; ``at`` packs ``start``, ``n - 1`` and ``off``."""
    def run(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                cols, rows = [[], [], [], [], []], 0
                for doc, nr, text in zip(*(c.to_pylist() for c in b.columns)):
                    key, ctx, start, n, off = entries(_bytes(text), length)
                    for c, v in zip(cols, (key, ctx, np.full(len(key), doc), np.full(len(key), nr), _pack(start, n, off))):
                        c.append(v)
                    rows += len(key)
                    if rows >= 200_000:
                        yield pa.record_batch([pa.array(np.concatenate(c)) for c in cols], names=["key", "ctx", "doc", "nr", "at"])
                        cols, rows = [[], [], [], [], []], 0
                if rows:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in cols], names=["key", "ctx", "doc", "nr", "at"])

    return docs.select("doc", "nr", "text").mapInArrow(run, "key long, ctx long, doc long, nr long, at long")


class IndexFamily:
    """Levels of a growing index; sizes are counted in batches."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        """Merge-scan a batch of entries later than all before against the levels.

        Returns ``doc, nr, at, full``: entries that repeat as a whole, and (``full``
        false) the first entries of contexts whose prefix has others.  With
        ``last`` the batch isn't kept as a level."""
        rows = batch.withColumn("old", F.lit(False))
        for _, level in self.levels:
            rows = rows.unionByName(level.withColumn("old", F.lit(True)))
        by, order = W.partitionBy("key"), W.partitionBy("key").orderBy("ctx", "doc", "nr", "at")
        rows = rows.select("*", F.lag("ctx").over(order).alias("last"), F.min("ctx").over(by).alias("low"), F.max("ctx").over(by).alias("high"))
        first = F.col("last").isNull() | (F.col("last") != F.col("ctx"))
        rows = rows.select("key", "ctx", "doc", "nr", "at", (~first).alias("full"), (first & (F.col("low") != F.col("high"))).alias("rival"),
                           (first & ~F.col("old")).alias("fresh"))
        wanted = F.col("full") | F.col("rival")
        scanned = saved(rows.filter(wanted if last else wanted | F.col("fresh")), "suffix-scan")
        if not last:
            self.levels.append((1, scanned.filter("fresh").select("key", "ctx", "doc", "nr", "at")))
            while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
                (n, a), (m, b) = self.levels.pop(), self.levels.pop()
                merged = a.unionByName(b).repartition("key").sortWithinPartitions("key", "ctx")
                self.levels.append((n + m, saved(merged, "suffix-level")))
        return scanned.filter(wanted).select("doc", "nr", "at", "full")


def _texts_of(docs: DataFrame, by_doc: DataFrame) -> DataFrame:
    """``docs`` joined with a table by ``(doc, nr)``, which grows with the corpus and is never broadcast."""
    return docs.join(by_doc.hint("merge"), ["doc", "nr"])


def _of_doc(ats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, n, off`` of packed entries."""
    ats = np.array(ats, np.int64)
    return ats >> 14, (ats >> 7 & 127) + 1, ats & 127


def longer_matches(docs: DataFrame, rivals: DataFrame, length: int) -> DataFrame:
    """``doc, nr, at, side`` of the rivals that share a longer match on a side (0 left, 1 right) with another."""
    rivals = saved(rivals.distinct(), "suffix-rivals")
    far = (length - GRAM) // 2

    def run(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                for doc, nr, text, ats in zip(*(c.to_pylist() for c in b.columns)):
                    start, n, off = _of_doc(ats)
                    grams = string_hashes(_bytes(text), length)[0]
                    anchor, ats = start + off, np.array(ats, np.int64)
                    left, right = off >= far, start + n - 1 + length >= anchor + GRAM + far
                    h = np.concatenate((_join(grams[anchor[left] - far], grams[anchor[left]]), _join(grams[anchor[right]], grams[anchor[right] + far])))
                    yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(np.full(len(h), doc)), pa.array(np.full(len(h), nr)), pa.array(np.concatenate((ats[left], ats[right]))),
                                           pa.array(np.repeat([0, 1], [left.sum(), right.sum()]).astype(np.int32))], names=["match", "doc", "nr", "at", "side"])

    by_doc = rivals.groupBy("doc", "nr").agg(F.collect_list("at").alias("ats"))
    rows = _texts_of(docs, by_doc).select("doc", "nr", "text", "ats").mapInArrow(run, "match long, doc long, nr long, at long, side int")
    by = W.partitionBy("match", "side")
    place = F.struct("doc", "nr", "at")
    return rows.select("doc", "nr", "at", "side", F.min(place).over(by).alias("low"), F.max(place).over(by).alias("high")) \
        .filter("low != high").select("doc", "nr", "at", "side").distinct()


def repeated_parts(docs: DataFrame, rivals: DataFrame, length: int) -> DataFrame:
    """``doc, nr, at`` of the single strings of ``rivals`` that an earlier one equals."""
    rivals = saved(longer_matches(docs, rivals, length), "suffix-longer")
    far = (length - GRAM) // 2

    def run(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                for doc, nr, text, ats, sides in zip(*(c.to_pylist() for c in b.columns)):
                    start, n, off = _of_doc(ats)
                    strings = string_hashes(_bytes(text), length)[1]
                    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    place = np.repeat(start, n) + inner
                    place = place[(np.repeat(off, n) - inner >= far) == (np.repeat(np.array(sides), n) == 0)]
                    yield pa.record_batch([pa.array(strings[place].view(np.int64)), pa.array(np.full(len(place), doc)),
                                           pa.array(np.full(len(place), nr)), pa.array(_pack(place, 1, 0))], names=["string", "doc", "nr", "at"])

    by_doc = rivals.groupBy("doc", "nr").agg(F.collect_list(F.struct("at", "side")).alias("x")) \
        .select("doc", "nr", F.col("x.at").alias("ats"), F.col("x.side").alias("sides"))
    strings = _texts_of(docs, by_doc).select("doc", "nr", "text", "ats", "sides") \
        .mapInArrow(run, "string long, doc long, nr long, at long")
    order = W.partitionBy("string").orderBy("doc", "nr", "at")
    first = F.first(F.struct("doc", "nr", "at")).over(order)  # equal rows are one document: their own first place isn't earlier
    return strings.withColumn("first", first).filter("doc != first.doc OR nr != first.nr OR at != first.at").select("doc", "nr", "at").distinct()


def _runs(ats, length: int) -> tuple[list[int], list[int]]:
    """Maximal byte runs covered by packed strings."""
    start, n, _ = _of_doc(np.sort(np.array(ats, np.int64)))
    end = np.maximum.accumulate(start + n - 1 + length)
    cut = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return start[cut].tolist(), end[np.append(cut[1:], len(start)) - 1].tolist()


def _with_order(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Add ``doc`` (never null) and ``nr``, which numbers the different texts under one id from 0; whether ids repeat."""
    docs = docs.withColumn("doc", F.coalesce("doc_id", F.lit(_NULL)))
    many = docs.select("doc").groupBy("doc").count().filter("count > 1")
    many = saved(many.select("doc"), "suffix-many")
    if many.isEmpty():
        return docs.withColumn("nr", F.lit(0).cast("long")), False
    mark = F.xxhash64("text")
    texts = docs.join(many, "doc", "left_semi").select("doc", mark.alias("mark")).distinct()
    texts = saved(texts.withColumn("nr", F.row_number().over(W.partitionBy("doc").orderBy("mark")).cast("long") - 1), "suffix-numbers")
    return docs.withColumn("mark", mark).join(texts, ["doc", "mark"], "left") \
        .withColumn("nr", F.coalesce("nr", F.lit(0).cast("long"))).drop("mark"), True


def remove_repeats(docs: DataFrame, length: int = 100, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    The corpus is indexed in ``batches`` batches of ascending ids."""
    if not 2 * GRAM <= length <= 4 * GRAM:
        raise ValueError("length must lie between 64 and 128 bytes")
    python_ready(docs.sparkSession)
    docs, repeated = _with_order(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc", shares)).first()[0] or [])) if shares else []
    family, covered = IndexFamily(), None
    for i in range(len(cuts) + 1):
        part = docs
        if i:
            part = part.filter(F.col("doc") >= cuts[i - 1])
        if i < len(cuts):
            part = part.filter(F.col("doc") < cuts[i])
        found = family.add(index_entries(part.dropDuplicates(["doc", "nr"]) if repeated else part, length), last=i == len(cuts))
        covered = found if covered is None else covered.unionByName(found)
    parts = repeated_parts(docs, covered.filter("NOT full").select("doc", "nr", "at"), length)
    ats = covered.filter("full").select("doc", "nr", "at").unionByName(parts)
    runs = saved(_merged(ats, length), "suffix-runs")
    total = runs.agg(F.sum(F.size("starts"))).first()[0] or 0

    def run(batches_):
        for b in batches_:
            out = [[], [], [], []]
            for text, starts, ends in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                digest, at, gone = hashlib.sha256(), 0, 0
                for s, e in zip(starts or (), ends or ()):
                    digest.update(raw[at:s])
                    gone, at = gone + e - s, e
                digest.update(raw[at:])
                for c, v in zip(out, (len(raw), gone, len(starts or ()), digest.hexdigest())):
                    c.append(v)
            yield pa.record_batch([b.column(0)] + [pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(out[3], pa.string())],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    side = F.broadcast(runs) if total <= BROADCAST_IDS else runs
    return docs.join(side, ["doc", "nr"], "left").select("doc_id", "text", "starts", "ends").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _merged(ats: DataFrame, length: int) -> DataFrame:
    """``doc, nr, starts, ends``: maximal byte runs by document (a group is one document's strings)."""
    by_doc = ats.groupBy("doc", "nr").agg(F.collect_list("at").alias("ats"))

    def run(batches):
        for b in batches:
            runs = [_runs(a, length) for a in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array([r[0] for r in runs], pa.list_(pa.int64())),
                                   pa.array([r[1] for r in runs], pa.list_(pa.int64()))], names=["doc", "nr", "starts", "ends"])

    return by_doc.select("doc", "nr", "ats").mapInArrow(run, "doc long, nr long, starts array<long>, ends array<long>")
