"""Exact top-k inner-product search, term at a time.

Rows are sparse integer vectors: terms (dimensions) with weights that aren't 0.
A task turns each batch of candidates into postings by term; a query goes
through its own terms and scatters ``weight * posting`` into one dense score
array over the batch.  Partition selection keeps the batch's best ``k`` for the
query, which are merged with the task's best so far; Spark merges the tasks'.
Every candidate gets its full score, so the result is exact.

Queries are worked through in blocks of about ``BLOCK`` rows.  Only a block is
ever sent to the driver and broadcast (64 dimensions: 4 MB); its result is
written before the next block starts.  Candidates are neither shuffled nor
grouped, so equal vectors or ids don't gather anywhere.  A task holds one batch
of ``TILE`` candidates, a score array of that length and ``k`` rows by query.

Edge cases: vectors that are null or hold a null or a component that isn't
finite take no part, nor do rows with a null id; a finite component of any size
does: vectors whose products could leave 64 bits are multiplied as whole
numbers without a bound, and only a score in the result that doesn't fit into
a long is an error; vectors of different lengths are taken as ended by zeros,
an empty vector scores 0; a row repeated under the query's own id isn't its
neighbour, an id repeated among candidates can appear twice; if a query id has
several vectors the least one asks; fewer candidates than ``k`` give fewer
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import python_ready, saved

BLOCK = 8192
TILE = 8192
_LONG = np.iinfo(np.int64)


def scaled(vector: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of every component as a double (exact, a product beyond doubles as the largest one), null unless all are finite."""
    xs = F.transform(vector, lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    most = float(np.finfo(np.float64).max)

    def whole(x: Column) -> Column:
        y = x * float(scale)
        return F.when(F.abs(y) < 2.0 ** 52, F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, F.lit(most)), F.lit(-most)))

    return F.when(vector.isNotNull() & ~F.exists(xs, bad), F.transform(xs, whole))


def wide(vector: np.ndarray) -> bool:
    """Whether an inner product with this vector may leave 64 bits.

    Without a wide one, two vectors of lengths m and n have at most min(m, n)
    products of at most 2^62 / sqrt(m * n)."""
    return bool(len(vector)) and float(np.abs(vector).max()) > (2.0 ** 62 / len(vector)) ** 0.5


def exact(a: np.ndarray, b: np.ndarray) -> int:
    """The inner product as a whole number, held at the ends of 64 bits."""
    n = sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist()) if x and y)
    return max(_LONG.min, min(_LONG.max, n))


def postings(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """By term: places of the vectors that hold it, and its weights."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    flat = np.concatenate(vectors).astype(np.int64) if len(vectors) else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(vectors)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = flat != 0
    flat, doc, term = flat[keep], doc[keep], term[keep]
    order = np.argsort(term, kind="stable")
    cuts = np.searchsorted(term[order], np.arange(int(sizes.max(initial=0)) + 1))
    return [(doc[order[a:b]], flat[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to the smaller id."""
    if len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= edge
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, ~scores))[:k]
    return ids[order], scores[order]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of each query.

    Both sides are ``(id long, terms array<double>)`` of whole numbers; null terms take no part."""
    spark = candidates.sparkSession
    python_ready(spark)
    asked = queries.filter("id IS NOT NULL AND terms IS NOT NULL").groupBy("id").agg(F.min("terms").alias("terms"))
    asked = saved(asked, "topk-queries")
    blocks = max(1, -(-asked.count() // block))
    out = None
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        held = spark.sparkContext.broadcast([(r.id, np.array(r.terms, np.float64)) for r in rows])
        part = _search(candidates, held, k)
        if blocks > 1:
            part = saved(part, "topk-block")
            held.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def _search(candidates: DataFrame, held, k: int) -> DataFrame:
    def run(batches):
        queries = [(q, v, None if wide(v) else [(t, w) for t, w in enumerate(v.astype(np.int64).tolist()) if w]) for q, v in held.value]
        none = np.empty(0, np.float64)
        ids = [np.empty(0, np.int64)] * len(queries)
        scores = [np.empty(0, np.int64)] * len(queries)
        for b in batches:
            for lo in range(0, b.num_rows, TILE):
                tile = b.slice(lo, TILE)
                own = tile.column(0).to_numpy(zero_copy_only=False)
                vectors = [np.array(v, np.float64) for v in tile.column(1).to_pylist()]
                beyond = [j for j, v in enumerate(vectors) if wide(v)]
                lists = postings([none if wide(v) else v for v in vectors])
                for i, (query, vector, terms) in enumerate(queries):
                    dense = np.zeros(len(own), np.int64)
                    for t, w in terms or ():
                        if t < len(lists):
                            at, weights = lists[t]
                            if len(at) == len(dense):
                                dense += w * weights
                            else:
                                dense[at] += w * weights
                    for j in beyond if terms is not None else range(len(own)):
                        dense[j] = exact(vector, vectors[j])
                    others = own != query
                    found, got = best(own[others], dense[others], k)
                    ids[i], scores[i] = best(np.concatenate((ids[i], found)), np.concatenate((scores[i], got)), k)
        n = [len(x) for x in ids]
        if sum(n):
            yield pa.record_batch([pa.array(np.repeat([q for q, _, _ in queries], n)), pa.array(np.concatenate(ids)),
                                   pa.array(np.concatenate(scores))], names=["query_id", "vec_id", "score"])

    rows = candidates.filter("id IS NOT NULL AND terms IS NOT NULL").select("id", "terms") \
        .mapInArrow(run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    fits = F.when(F.col("score").isin(int(_LONG.min), int(_LONG.max)), F.raise_error(F.lit("a score of the result doesn't fit into a long"))) \
        .otherwise(F.col("score")).alias("score")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", fits)
