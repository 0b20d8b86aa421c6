"""V8, V9: approximate top-k by cluster lists, and its recall.

Build: ``pyspark.ml`` k-means with cosine distance over the (non-zero)
corpus vectors gives ``lists`` centroids -- a tiny table.  Every vector is
assigned to its nearest centroid (``list_id``, a column that can partition
the stored vectors).  Search: each query probes its ``nprobe`` nearest
centroids (centroids and query vectors are broadcast); each task scores a
document only against the queries probing that document's list and keeps a
local top-k -- the corpus is never shuffled, so a large list never lands on
one task.  With ``nprobe == lists`` the result equals exact search.

``build_lists`` is the repeatable form: centroids are corpus vectors far from
each other (no seed, ties by id), and the vectors are stored in a folder per
list, large lists over several files, so that a search reads only the folders
of the lists it probes.

The list count follows the usual sizing rule (rows / 1000 up to 1M rows,
sqrt(rows) above) unless given.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._ship import ensure_package
from ..session import materialize
from .limits import cut, query_limits
from .vectorsearch import DEFAULT_MAX_BROADCAST, _local_topk, _score_matrix


def default_lists(n_rows: int) -> int:
    return max(1, n_rows // 1000) if n_rows <= 1_000_000 else max(1, int(math.sqrt(n_rows)))


def build_ivf(corpus_vecs: DataFrame, lists: int | None = None, seed: int = 42,
              max_iter: int = 20, doc_id: str = "doc_id", vec: str = "vec"):
    """Return ``(centroids ndarray (lists, d), assigned DataFrame(doc_id, list_id, vec))``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    spark = corpus_vecs.sparkSession
    ensure_package(spark)
    nz = corpus_vecs.where(F.exists(vec, lambda x: x != 0))
    n = nz.count()
    lists = min(lists or default_lists(n), max(n, 1))
    train = nz.select(array_to_vector(vec).alias("features"))
    model = KMeans(k=lists, seed=seed, maxIter=max_iter, distanceMeasure="cosine",
                   featuresCol="features").fit(train)
    cents = np.array([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])
    cn = np.linalg.norm(cents, axis=1)
    cents = cents / np.where(cn == 0, 1.0, cn)[:, None]
    bc = spark.sparkContext.broadcast(cents)

    def assign(batches):
        c = bc.value
        for pdf in batches:
            m = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec]]) if len(pdf) else np.zeros((0, c.shape[1]))
            lid = np.argmax(m @ c.T, axis=1) if len(pdf) else np.zeros(0, dtype=np.int64)
            pdf = pdf.assign(list_id=lid.astype(np.int32))
            yield pdf[[doc_id, "list_id", vec]]

    schema = f"{doc_id} long, list_id int, {vec} array<double>"
    assigned = corpus_vecs.select(F.col(doc_id).cast("long"), F.col(vec).cast("array<double>")).mapInPandas(assign, schema)
    return cents, assigned


def farthest_centroids(vecs: DataFrame, lists: int, doc_id: str = "doc_id", vec: str = "vec") -> np.ndarray:
    """Up to ``lists`` corpus vectors, normalised: the one of the smallest id, then
    each time the one whose highest cosine (6 places) to those chosen is lowest,
    ties to the smaller id.  Zero and null vectors are never chosen; vectors
    equal in direction count once.  One scan of ``vecs`` for each centroid;
    only one row of each scan comes back."""
    spark = vecs.sparkSession
    ensure_package(spark)
    nz = vecs.select(F.col(doc_id).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.exists("v", lambda x: x != 0))

    def closeness(bc):
        def run(batches):
            for pdf in batches:
                if len(pdf):
                    m = np.stack(pdf["v"].to_numpy())
                    yield pdf.assign(near=_score_matrix("cosine", m, bc.value, np.ones(len(bc.value)))[1].max(axis=1))
        return run

    first = nz.agg(F.min_by("v", "id").alias("v")).first()["v"]
    chosen = [] if first is None else [np.asarray(first) / np.linalg.norm(first)]
    while chosen and len(chosen) < lists:
        bc = spark.sparkContext.broadcast(np.array(chosen))
        far = nz.mapInPandas(closeness(bc), "id long, v array<double>, near double") \
            .agg(F.min(F.struct("near", "id", "v")).alias("m")).first()["m"]
        if far["near"] >= 1.0:
            break
        chosen.append(np.asarray(far["v"]) / np.linalg.norm(far["v"]))
    return np.array(chosen)


def assign_lists(vecs: DataFrame, centroids: np.ndarray, doc_id: str = "doc_id", vec: str = "vec") -> DataFrame:
    """``(doc_id, list_id, vec)``: the list of the highest cosine (6 places), ties to the smaller list; zero vectors in list 0."""
    bc = vecs.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                near = _score_matrix("cosine", np.stack(pdf["vec"].to_numpy()), bc.value, np.ones(len(bc.value)))[1]
                yield pdf.assign(list_id=near.argmax(axis=1).astype(np.int32))[["doc_id", "list_id", "vec"]]

    return vecs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(vec).cast("array<double>").alias("vec")) \
        .where(F.col("vec").isNotNull()).mapInPandas(run, "doc_id long, list_id int, vec array<double>")


def build_lists(vecs: DataFrame, path: str, lists: int | None = None, rows_per_file: int = 100_000,
                centroids: np.ndarray | None = None, doc_id: str = "doc_id", vec: str = "vec"):
    """Store ``vecs`` under ``path``, a folder per list; ``(centroids, stored DataFrame(doc_id, vec, list_id))``.

    Without ``centroids`` they are chosen by ``farthest_centroids``.  A list
    above ``rows_per_file`` is dealt over several tasks and files by a hash
    of the id.  Null vectors are left out."""
    spark = vecs.sparkSession
    if centroids is None:
        centroids = farthest_centroids(vecs, lists or default_lists(vecs.count()), doc_id, vec)
    if len(centroids) == 0:
        centroids = np.zeros((1, 1 if vecs.isEmpty() else len(vecs.first()[vec] or [0.0])))
    assigned = materialize(assign_lists(vecs, centroids, doc_id, vec), "lists")
    sizes = assigned.groupBy("list_id").agg(F.ceil(F.count("*") / rows_per_file).alias("_files"))
    dealt = assigned.join(F.broadcast(sizes), "list_id").withColumn("_file", F.pmod(F.xxhash64("doc_id"), F.col("_files")))
    dealt.repartition("list_id", "_file").drop("_files", "_file").write.partitionBy("list_id") \
        .option("maxRecordsPerFile", rows_per_file).parquet(path)
    return centroids, spark.read.schema("doc_id long, vec array<double>, list_id int").parquet(path)


def ivf_search(queries: DataFrame, centroids: np.ndarray, assigned: DataFrame, k: int = 20,
               nprobe: int = 1, query_id: str = "query_id", vec: str = "vec",
               max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST, k_col: str | None = None) -> DataFrame:
    """``(query_id, rank, doc_id, score)`` over the probed lists only (cosine).

    ``k_col`` names a column of the queries with each one's own limit; without it all take ``k``."""
    spark = assigned.sparkSession
    ensure_package(spark)
    q = queries.select(F.col(query_id).cast("long").alias("qid"), F.col(vec).alias("qv"))
    n_q = q.count()
    k, limits = query_limits(queries.withColumnRenamed(k_col, "k") if k_col else None, k, query_id)
    if n_q == 0:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    d = centroids.shape[1]
    # Query vectors are broadcast in blocks of bounded size (as in knn).
    block = max(1, max_broadcast_bytes // (d * 8 + len(centroids) + 64))
    nb = (n_q + block - 1) // block
    blocks = [q] if nb == 1 else [
        q.where(F.pmod(F.xxhash64("qid"), F.lit(nb)) == b) for b in range(nb)]
    parts = []
    for qb in blocks:
        rows = qb.orderBy("qid").collect()
        if rows:
            parts.append(_ivf_block(spark, rows, centroids, assigned, k, nprobe, vec))
    local = parts[0]
    for p_ in parts[1:]:
        local = local.unionByName(p_)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return cut(local.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k), limits) \
        .select("query_id", "rank", "doc_id", "score")


def _ivf_block(spark, rows, centroids, assigned, k, nprobe, vec):
    d = centroids.shape[1]
    qids = np.array([r["qid"] for r in rows], dtype=np.int64)
    qmat = np.array([np.asarray(r["qv"] if r["qv"] is not None else [0.0] * d, dtype=np.float64) for r in rows])
    nprobe = min(nprobe, len(centroids))
    sims = _score_matrix("cosine", qmat, centroids, np.linalg.norm(centroids, axis=1))[1]
    probes = np.argsort(-sims, axis=1, kind="stable")[:, :nprobe]
    probe_mask = np.zeros((len(qids), len(centroids)), dtype=bool)
    probe_mask[np.arange(len(qids))[:, None], probes] = True
    bc = spark.sparkContext.broadcast((qids, qmat, probe_mask))

    def score(batches):
        import pandas as pd
        qi, qm, pm = bc.value
        qn = np.sqrt((qm * qm).sum(axis=1))
        for pdf in batches:
            if pdf.empty:
                continue
            ids = pdf["doc_id"].to_numpy(dtype=np.int64)
            lids = pdf["list_id"].to_numpy(dtype=np.int64)
            dm = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vec]])
            oq, od, os_ = [], [], []
            for lid in np.unique(lids):
                rsel = np.flatnonzero(lids == lid)
                qsel = np.flatnonzero(pm[:, lid])
                if len(qsel) == 0:
                    continue
                key, val = _score_matrix("cosine", dm[rsel], qm[qsel], qn[qsel])
                for jj, j in enumerate(qsel):
                    sel = _local_topk(key[:, jj], ids[rsel], k)
                    oq.append(np.full(len(sel), qi[j], dtype=np.int64))
                    od.append(ids[rsel][sel])
                    os_.append(val[sel, jj])
            if oq:
                yield pd.DataFrame({"query_id": np.concatenate(oq), "doc_id": np.concatenate(od),
                                    "score": np.concatenate(os_)})

    # Lists that no query probes aren't read where the vectors are stored by list.
    if not probe_mask.any(axis=0).all():
        assigned = assigned.where(F.col("list_id").isin([int(x) for x in np.flatnonzero(probe_mask.any(axis=0))]))
    # No shuffle of the corpus: any task can score any document; sorting
    # inside each partition only groups a list's documents into one product.
    return assigned.sortWithinPartitions("list_id").mapInPandas(score, "query_id long, doc_id long, score double")


def recall_at_k(approx: DataFrame, exact: DataFrame, k: int = 20) -> DataFrame:
    """V9: per query, the share of the exact top-k found by the approximate run."""
    common = approx.select("query_id", "doc_id").join(exact.select("query_id", "doc_id"), ["query_id", "doc_id"])
    n_exact = exact.groupBy("query_id").agg(F.count("*").alias("n_exact"))
    c = common.groupBy("query_id").agg(F.count("*").alias("n_common"))
    return (n_exact.join(c, "query_id", "left").fillna(0, ["n_common"])
            .select("query_id", "n_exact", "n_common",
                    F.round(F.col("n_common") / F.least(F.col("n_exact"), F.lit(k)), 6).alias("recall")))
