"""Exact top-k vector search for a whole table of queries.

Plan: the query vectors are small (size checked before they are shipped);
they are broadcast once as a NumPy matrix.  Each task scores its slice of
the corpus in tiles of bounded size and keeps a running *local* top-k per
query (exact, with the same tie-break as the final order), so at most ``k``
rows per query leave the task, and its memory is that of a block of queries,
its best and a tile, whatever the numbers of rows.  A final
``row_number() <= k`` over ``query_id`` merges the partial lists; Spark plans
it as a partial + final ``WindowGroupLimit``.  No pair of (query, document)
is ever materialised as a row, and the corpus is never shuffled.

When the query matrix is larger than ``max_broadcast_bytes`` the queries are
processed in blocks of that size (each block is one more scan of the corpus),
which keeps the driver and executor memory bounded for any query count.

Scores are rounded to 6 places before ranking (ties then break on the id),
so that the ranking is the one a SQL engine computes from the same numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._ship import ensure_package
from ..functions.text import limit_rule

METRICS = ("cosine", "l2", "ip")
DEFAULT_MAX_BROADCAST = 32 << 20
# A task holds a broadcast block of queries, their best so far and one tile of scores.
TILE_DOCS, TILE_CELLS = 2048, 1 << 20


def _local_topk(keys: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best rows: smallest ``keys``, ties by smaller id."""
    n = len(keys)
    if n <= k:
        return np.lexsort((ids, keys))
    kth = np.partition(keys, k - 1)[k - 1]
    lt = np.flatnonzero(keys < kth)
    eq = np.flatnonzero(keys == kth)
    need = k - len(lt)
    if len(eq) > need:
        eq = eq[np.argpartition(ids[eq], need - 1)[:need]] if need > 0 else eq[:0]
    sel = np.concatenate((lt, eq))
    return sel[np.lexsort((ids[sel], keys[sel]))]


def _score_matrix(metric: str, docs: np.ndarray, qmat: np.ndarray, qnorm: np.ndarray):
    """Return (sort_key, reported value) matrices of shape (n_docs, n_queries).

    cosine: value = similarity (zero-safe: 0 when a norm is 0), key = -value
    l2:     value = distance, key = value
    ip:     value = negative inner product, key = value
    """
    dot = docs @ qmat.T
    if metric == "cosine":
        dn = np.sqrt((docs * docs).sum(axis=1))
        den = dn[:, None] * qnorm[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            val = np.where(den == 0, 0.0, dot / np.where(den == 0, 1.0, den))
        val = np.round(val, 6) + 0.0
        return -val, val
    if metric == "l2":
        dn2 = (docs * docs).sum(axis=1)
        near = dn2[:, None] + (qnorm * qnorm)[None, :]
        d2 = near - 2.0 * dot
        # The expanded form loses digits where points lie close to each other; these are taken from the differences.
        i, j = np.nonzero(d2 < 1e-3 * near)
        for a in range(0, len(i), 1 << 14):
            ia, ja = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
            d2[ia, ja] = ((docs[ia] - qmat[ja]) ** 2).sum(axis=1)
        val = np.round(np.sqrt(np.maximum(d2, 0.0)), 6) + 0.0
        return val, val
    if metric == "ip":
        val = np.round(-dot, 6) + 0.0
        return val, val
    raise ValueError(f"unknown metric {metric}")


def knn(queries: DataFrame, corpus: DataFrame, k: int = 20, metric: str = "cosine",
        query_id: str = "query_id", query_vec: str = "vec", doc_id: str = "doc_id",
        doc_vec: str = "vec", k_col: str | None = "k", exclude_self: bool = False,
        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST) -> DataFrame:
    """Exact top-k: ``(query_id, rank, doc_id, score)``.

    ``score`` is the cosine similarity (``1 - distance``, higher first) for
    ``cosine``; the distance (smaller first) for ``l2``; the negative inner
    product (smaller first) for ``ip``.  Null corpus vectors are skipped.
    ``exclude_self`` drops the pair ``query_id == doc_id`` (kNN of a table
    against itself).  A ``k`` column on the queries limits each query; ``k``
    is the upper bound used by the pruning."""
    if metric not in METRICS:
        raise ValueError(metric)
    spark = corpus.sparkSession
    ensure_package(spark)
    qcols = [F.col(query_id).cast("long").alias("qid"), F.col(query_vec).alias("qv")]
    if k_col and k_col in queries.columns:
        qcols.append(limit_rule(F.col(k_col), k).alias("qk"))
    else:
        qcols.append(F.lit(k).cast("int").alias("qk"))
    q = queries.select(*qcols)
    # Size check before anything reaches the driver: vectors, and the best k of each in a task.
    stats = q.agg(F.count("*").alias("n"), F.max(F.size("qv")).alias("d"),
                  F.max("qk").alias("kmax")).collect()[0]
    n_q, dims = int(stats["n"]), int(stats["d"] or 0)
    k = int(stats["kmax"] or k)
    docs = corpus.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.col(doc_vec).alias("dv")).where(F.col("dv").isNotNull())
    out_schema = "query_id long, doc_id long, key double"
    if n_q == 0:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    per_query = max(dims, 1) * 8 + 64 + 16 * k
    block = max(1, max_broadcast_bytes // per_query)
    parts = []
    if n_q <= block:
        blocks = [q]
    else:
        nb = (n_q + block - 1) // block
        qb = q.withColumn("_blk", F.pmod(F.xxhash64("qid"), F.lit(nb)))
        blocks = [qb.where(F.col("_blk") == b).drop("_blk") for b in range(nb)]
    for qblk in blocks:
        rows = qblk.select("qid", "qv").orderBy("qid").toArrow()
        if not rows.num_rows:
            continue
        qids = rows["qid"].to_numpy().astype(np.int64)
        qmat = np.array([np.asarray(v if v is not None else [0.0] * dims, dtype=np.float64)
                         for v in rows["qv"].to_numpy()])
        bc = spark.sparkContext.broadcast((qids, qmat))
        parts.append(docs.mapInPandas(_make_scorer(bc, metric, k, exclude_self), out_schema))
    local = parts[0]
    for p in parts[1:]:
        local = local.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.col("key").asc(), F.col("doc_id").asc())
    ranked = (local.withColumn("rank", F.row_number().over(w))
              .where(F.col("rank") <= F.lit(k)))
    if k_col and k_col in queries.columns:
        kq = q.select(F.col("qid").alias("query_id"), "qk")
        kq = F.broadcast(kq) if n_q <= block else kq
        ranked = ranked.join(kq, "query_id").where(F.col("rank") <= F.col("qk"))
    score = -F.col("key") + F.lit(0.0) if metric == "cosine" else F.col("key")
    return ranked.select("query_id", F.col("rank").cast("int"), "doc_id", score.alias("score"))


class _Best:
    """The ``k`` best ``(key, id)`` of each of ``n`` queries, updated tile by tile."""

    def __init__(self, n: int, k: int):
        self.k, self.filled = k, np.zeros(n, dtype=np.int64)
        self.key = np.empty((n, k))
        self.id = np.empty((n, k), dtype=np.int64)
        self.last = np.full(n, np.nan)  # the k-th key; nan lets everything in

    def update(self, first: int, key: np.ndarray, ids: np.ndarray, out: np.ndarray | None) -> None:
        """``key``: (documents, queries from ``first``); cells that are true in ``out`` don't count."""
        last = self.last[first:first + key.shape[1]]
        if out is not None:
            key = np.where(out, np.nan, key)
        take = ~(key > last)
        # Where far more than k are left, the k-th key of the tile is a bound too (nan comes last).
        if len(key) > 4 * self.k:
            many = np.flatnonzero(take.sum(axis=0) > 4 * self.k)
            if len(many):
                some = key[:, many]
                take[:, many] &= ~(some > np.partition(some, self.k - 1, axis=0)[self.k - 1])
        if out is not None:
            take &= ~out
        doc, q = np.nonzero(take)
        if not len(q):
            return
        own = np.unique(q) + first
        at, slot = np.nonzero(np.arange(self.k) < self.filled[own][:, None])
        at = own[at]
        q = np.concatenate((at, q + first))
        keys = np.concatenate((self.key[at, slot], key[doc, q[len(at):] - first]))
        got = np.concatenate((self.id[at, slot], ids[doc]))
        order = np.lexsort((got, keys, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        order, q, rank = order[rank < self.k], q[rank < self.k], rank[rank < self.k]
        self.key[q, rank], self.id[q, rank] = keys[order], got[order]
        self.filled[own] = np.bincount(q - own[0], minlength=own[-1] - own[0] + 1)[own - own[0]]
        full = own[self.filled[own] == self.k]
        self.last[full] = self.key[full, -1]


def _make_scorer(bc, metric: str, k: int, exclude_self: bool, cells: int = TILE_CELLS):
    """Scores tiles of at most ``cells`` documents x queries and keeps ``k`` per query and task."""

    def scorer(batches):
        import pandas as pd
        qids, qmat = bc.value
        qnorm = np.sqrt((qmat * qmat).sum(axis=1))
        best = _Best(len(qids), k)
        for pdf in batches:
            for a in range(0, len(pdf), TILE_DOCS):
                part = pdf.iloc[a:a + TILE_DOCS]
                ids = part["doc_id"].to_numpy(dtype=np.int64)
                dm = np.stack([np.asarray(v, dtype=np.float64) for v in part["dv"]])
                width = max(1, cells // len(ids))
                for j in range(0, len(qids), width):
                    key = _score_matrix(metric, dm, qmat[j:j + width], qnorm[j:j + width])[0]
                    best.update(j, key, ids, ids[:, None] == qids[j:j + width] if exclude_self else None)
        rows = max(1, cells // (4 * k))
        for j in range(0, len(qids), rows):
            q, slot = np.nonzero(np.arange(k) < best.filled[j:j + rows][:, None])
            key = best.key[j:j + rows][q, slot]
            if len(q):
                yield pd.DataFrame({"query_id": qids[j:j + rows][q], "doc_id": best.id[j:j + rows][q, slot], "key": key})
    return scorer


def vector_norms(vecs: DataFrame, id_col: str = "query_id", vec_col: str = "vec") -> DataFrame:
    return vecs.select(id_col, F.sqrt(F.aggregate(vec_col, F.lit(0.0), lambda s, x: s + x * x))
                       .alias("query_norm"))


def top_dims(vecs: DataFrame, id_col: str = "query_id", vec_col: str = "vec", n: int = 5) -> DataFrame:
    """The ``n`` non-zero dimensions of largest absolute value per vector
    (ties: lower dimension first) -> ``(id, rank, dim, value)``."""
    e = vecs.select(id_col, F.posexplode(vec_col).alias("dim", "value")).where(F.col("value") != 0)
    w = Window.partitionBy(id_col).orderBy(F.abs("value").desc(), F.col("dim").asc())
    return (e.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select(id_col, F.col("rank").cast("int"), F.col("dim").cast("int"), "value"))
