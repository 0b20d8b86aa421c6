"""Substring overlap ranking, trigram similarity, ILIKE.

A substring predicate has no equi-join key of its own.  Both substring
operators get one from grams: a string that contains a pattern contains each
gram of it, so a pattern looks up only its *rarest* gram of three characters
(or itself, when shorter) among the grams of the strings, and what is longer
than a gram is verified.

* R4 -- a query term holds no white space, so it lies inside one white-space
  chunk of a document.  Terms are matched with the distinct chunks of the
  corpus (its vocabulary, much smaller than the text), and chunks lead to
  documents by an equi-join; scores are then summed as in R6.
* R7 -- the same lookup on the strings of one column.
* R6 -- scan counting: each task counts, for a batch of titles, how many
  grams each title shares with each query from the queries' gram lists.
  Counts stay inside the task; a running k-th similarity by query drops what
  can't be among the best any more.  No pair below the threshold is a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._ship import ensure_package
from ..functions.text import BLANK, WORD_PATTERN, is_blank
from ..session import materialize
from .ingest import assign_ids
from .limits import cut, query_limits

GRAM = 3
QUERY_BLOCK_BYTES = 64 << 20
_CELLS = 4 << 20     # counters of a tile of titles x queries
_PIECE = 8 << 20     # increments done at once


# -- substring lookup ------------------------------------------------------------

def _substrings(s: Column, n: int) -> Column:
    """Distinct substrings of ``n`` characters, by one pass of a look-ahead; the empty one for ``n = 0``."""
    if n == 0:
        return F.array(F.lit(""))
    return F.array_distinct(F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))"), 1))


def substring_candidates(patterns: DataFrame, strings: DataFrame) -> DataFrame:
    """``(pattern, sid, exact)``: strings holding the rarest gram of a pattern, whose every gram lies in some string.

    ``patterns(pattern)`` are distinct, ``strings(sid, s)`` are looked through.
    Patterns of at most three characters are their own gram, so their rows
    are ``exact``; the others are still to be verified.  An empty pattern
    lies in every string."""
    n = F.least(F.length("pattern"), F.lit(GRAM))
    lengths = sorted(r["n"] for r in patterns.select(n.alias("n")).distinct().collect())
    grams = F.array().cast("array<string>")
    for i in lengths:
        grams = F.when(n == i, _substrings(F.col("pattern"), i)).otherwise(grams)
    keys = patterns.select("pattern", F.explode(grams).alias("gram"))
    of_strings = [_substrings(F.col("s"), i) for i in lengths] or [F.array().cast("array<string>")]
    index = strings.select("sid", F.explode(F.concat(*of_strings)).alias("gram"))
    sizes = index.join(materialize(keys.select("gram").distinct(), "grams"), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = materialize(keys.join(sizes, "gram").groupBy("pattern").agg(F.min(F.struct("n", "gram")).alias("m"), F.count("*").alias("held"))
                         .join(keys.groupBy("pattern").agg(F.count("*").alias("grams")), "pattern").where("held = grams")
                         .select("pattern", F.col("m.gram").alias("gram")), "rarest-grams")
    return rarest.join(index, "gram").select("pattern", "sid", (F.length("pattern") <= GRAM).alias("exact"))


# -- R4 ------------------------------------------------------------------------

def overlap_search(corpus: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``(query_id, rank, doc_id, score)``.

    Query: lower-cased, split on white space (Unicode separators too).  Each
    term that is a substring of ``lower(title + ' ' + body)`` adds 1, plus 0.5
    when it is also in the lower-cased title; repeated terms count again;
    score > 0 kept; ties by id.  Ids of documents are distinct; nulls count
    as empty texts."""
    ensure_package(corpus.sparkSession)
    q = queries.where(~is_blank(F.col("q")))
    k, limits = query_limits(q, k)
    chunks = lambda c: F.array_distinct(F.split(F.lower(F.coalesce(c, F.lit(""))), f"{BLANK}+"))
    terms = (q.select(F.col("query_id").cast("long"), F.explode(F.split(F.lower(F.col("q")), f"{BLANK}+")).alias("term"))
             .where(F.length("term") > 0).groupBy("query_id", "term").agg(F.count("*").alias("n")))
    numbers = materialize(assign_ids(terms.select("term").distinct(), ["term"]).select(F.col("id").alias("no"), "term"), "terms")
    wanted = materialize(terms.join(numbers, "term").groupBy(F.col("query_id").alias("id"))
                         .agg(F.collect_list("no").alias("terms"), F.collect_list("n").alias("ns")), "query-terms")
    docs = corpus.select(F.col("doc_id").cast("long"), chunks(F.col("title")).alias("t"), chunks(F.col("body")).alias("b"))
    placed = docs.select("doc_id", F.explode(F.concat(
        F.transform("t", lambda c: F.struct(c.alias("chunk"), F.lit(True).alias("in_title"))),
        F.transform(F.array_except("b", "t"), lambda c: F.struct(c.alias("chunk"), F.lit(False).alias("in_title"))))).alias("x")
    ).select("doc_id", "x.*")
    vocabulary = materialize(placed.select("chunk").distinct(), "chunks").select(F.col("chunk").alias("sid"), F.col("chunk").alias("s"))
    found = substring_candidates(numbers.select(F.col("term").alias("pattern")), vocabulary)
    of_chunk = materialize(found.where(F.col("exact") | F.contains("sid", "pattern"))
                           .join(numbers.withColumnRenamed("term", "pattern"), "pattern")
                           .groupBy(F.col("sid").alias("chunk")).agg(F.collect_list("no").alias("nos")), "chunk-terms")
    held = placed.join(of_chunk, "chunk").groupBy("doc_id").agg(
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("in_title"), F.col("nos"))))).alias("t"),
        F.array_distinct(F.flatten(F.collect_list(F.when(~F.col("in_title"), F.col("nos"))))).alias("b"))
    held = materialize(held.select("doc_id", "t", F.array_except("b", "t").alias("b")), "document-terms")
    scores = _by_blocks(wanted, held, "terms", lambda rows: (
        *_lists_of([r["id"] for r in rows], [r["terms"] for r in rows]),
        np.concatenate([np.array(r["ns"], dtype=np.float64) for r in rows])),
        lambda bc: _overlap_scorer(bc, k), "query_id long, doc_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return cut(scores.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k), limits) \
        .select("query_id", "rank", "doc_id", "score")


def _overlap_scorer(bc, k):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        qids, _, terms, starts, members, order, ns = bc.value
        ns = ns[order]
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float64))
        least = np.zeros(len(qids))
        step = max(1, _CELLS // len(qids))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                tile = batch.slice(at, step)
                ids = tile.column(0).to_numpy()
                score = np.zeros((len(ids), len(qids)))
                for column, weight in ((1, 1.5), (2, 1.0)):
                    no = tile.column(column).flatten().to_numpy()
                    row = np.repeat(np.arange(len(ids)), pc.list_value_length(tile.column(column)).to_numpy())
                    place = np.minimum(np.searchsorted(terms, no), len(terms) - 1)
                    known = terms[place] == no
                    score += weight * _shared(row[known], place[known], len(ids), len(qids), starts, members, ns)
                i, j = np.nonzero((score > 0) & (score >= least))
                held = tuple(np.concatenate(p) for p in zip(held, (j, ids[i], score[i, j])))
                *held, least = _best(*held, k, len(qids))
        q, doc, score = held
        yield pa.RecordBatch.from_arrays([pa.array(qids[q]), pa.array(doc), pa.array(score)], names=["query_id", "doc_id", "score"])
    return run


# -- scan counting ---------------------------------------------------------------

def _by_blocks(queries: DataFrame, docs: DataFrame, column: str, packed, scorer, schema: str) -> DataFrame:
    """``scorer`` over ``docs`` for the queries, shipped in blocks of about ``QUERY_BLOCK_BYTES`` (one scan for each)."""
    spark = docs.sparkSession
    size = queries.agg(F.sum(F.size(column) * 32 + 64)).first()[0] or 0
    blocks = -(-size // QUERY_BLOCK_BYTES)
    found = spark.createDataFrame([], schema)
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        if rows:
            found = found.unionByName(docs.mapInArrow(scorer(spark.sparkContext.broadcast(packed(rows))), schema))
    return found


def _lists_of(ids, lists):
    """``(ids, sizes, keys, starts, members, order)``: queries in key order, those of key g at ``starts[g]:starts[g + 1]``."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    flat = [x for one in lists for x in one]
    keys, place = np.unique(np.array(flat, dtype=object if flat and isinstance(flat[0], str) else np.int64), return_inverse=True)
    order = np.argsort(place, kind="stable")
    members = np.repeat(np.arange(len(ids)), sizes)[order]
    starts = np.searchsorted(place[order], np.arange(len(keys) + 1))
    return np.array(ids, dtype=np.int64), sizes, keys, starts, members, order


def _shared(row, gram, n_rows, n_queries, starts, members, weights=None):
    """Shared keys, documents x queries, from the documents' occurrences ``(row, gram)``: counts, or sums of the weights."""
    fan = starts[gram + 1] - starts[gram]
    counts = np.zeros(n_rows * n_queries, dtype=np.int64 if weights is None else np.float64)
    ends = np.cumsum(fan)
    lo = 0
    while lo < len(fan):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + _PIECE, side="right")))
        f = fan[lo:hi]
        first = np.cumsum(f) - f
        at = np.repeat(starts[gram[lo:hi]] - first, f) + np.arange(f.sum())
        counts += np.bincount(np.repeat(row[lo:hi], f) * n_queries + members[at],
                              None if weights is None else weights[at], len(counts))
        lo = hi
    return counts.reshape(n_rows, n_queries)


def _best(q, doc, key, k, n_queries):
    """The ``k`` best hits of each query, and the key that a further hit of it must reach."""
    order = np.lexsort((doc, -key, q))
    q, doc, key = q[order], doc[order], key[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    least = np.zeros(n_queries, dtype=key.dtype)
    least[q[rank == k - 1]] = key[rank == k - 1]
    return q[rank < k], doc[rank < k], key[rank < k], least


# -- R7 ------------------------------------------------------------------------

def ilike_matches(corpus: DataFrame, patterns: DataFrame, column: str = "title") -> DataFrame:
    """``(query_id, doc_id)`` where ``column ILIKE '%' || pattern || '%'``.

    ``patterns(query_id, pattern)`` of any number; a null pattern counts as
    empty, an empty one matches every document; a null column as empty."""
    docs = corpus.select(F.col("doc_id").cast("long").alias("sid"), F.lower(F.coalesce(column, F.lit(""))).alias("s"))
    p = patterns.select("query_id", F.lower(F.coalesce("pattern", F.lit(""))).alias("pattern"))
    found = substring_candidates(p.select("pattern").distinct(), docs)
    verified = (found.where(~F.col("exact")).join(docs, "sid").where(F.contains("s", "pattern")).select("pattern", "sid"))
    pairs = found.where("exact").select("pattern", "sid").unionByName(verified)
    return p.join(pairs, "pattern").select("query_id", F.col("sid").alias("doc_id"))


# -- R6 ------------------------------------------------------------------------

def trigram_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Words lower-cased and padded with two blanks before and one after;
    the *set* of their 3-character grams -> ``(id, gram)`` distinct rows."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD_PATTERN), 0)
    w = df.select(F.col(id_col).alias("id"), F.explode(words).alias("word"))
    p = w.select("id", F.concat(F.lit("  "), F.col("word"), F.lit(" ")).alias("p"))
    g = p.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.length("p") - 2),
                                             lambda i: F.substring(F.col("p"), i, 3))).alias("gram"))
    return g.distinct()


def trigram_similarity_join(left: DataFrame, right: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Exact ``(lid, rid, similarity)`` with ``similarity >= threshold``.

    ``left(id, gram)`` / ``right(id, gram)`` are gram sets.  Prefix filter
    on a global rarest-first gram order, then exact overlap for candidates.
    ``threshold`` is taken as a fraction num/den with den = 1000."""
    num = int(round(threshold * 1000))
    den = 1000
    freq = (left.select("gram").unionAll(right.select("gram")).groupBy("gram")
            .agg(F.count("*").alias("_f")))

    def prefixed(side):
        s = side.join(freq, "gram")
        w = Window.partitionBy("id").orderBy(F.col("_f").asc(), F.col("gram").asc())
        wn = Window.partitionBy("id")
        s = s.select("id", "gram", F.row_number().over(w).alias("_r"), F.count("*").over(wn).alias("_n"))
        # prefix length n - ceil(t n) + 1 in integers
        plen = F.col("_n") - F.floor((F.col("_n") * num + (den - 1)) / den) + 1
        return s.withColumn("_pre", F.col("_r") <= plen)

    lp, rp = prefixed(left), prefixed(right)
    cand = (lp.where("_pre").select(F.col("id").alias("lid"), "gram", F.col("_n").alias("ln"))
            .join(rp.where("_pre").select(F.col("id").alias("rid"), "gram", F.col("_n").alias("rn")), "gram")
            .select("lid", "rid", "ln", "rn").distinct())
    # size filter: t * |x| <= |y| <= |x| / t
    cand = cand.where((F.col("rn") * den >= F.col("ln") * num) & (F.col("ln") * den >= F.col("rn") * num))
    inter = (cand.join(left.select(F.col("id").alias("lid"), "gram"), "lid")
             .join(right.select(F.col("id").alias("rid"), "gram"), ["rid", "gram"])
             .groupBy("lid", "rid", "ln", "rn").agg(F.count("*").alias("inter")))
    sim = F.col("inter") / (F.col("ln") + F.col("rn") - F.col("inter"))
    return (inter.select("lid", "rid", sim.alias("similarity"))
            .where(F.col("inter") * den >= (F.col("ln") + F.col("rn") - F.col("inter")) * num))


def gram_lists(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The sets of ``trigram_sets`` as arrays ``(id, grams)``, built row by row; texts without a word have none."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD_PATTERN), 0))
    grams = F.array_distinct(F.flatten(F.transform(words, lambda x: _substrings(F.concat(F.lit("  "), x, F.lit(" ")), GRAM))))
    return df.select(F.col(id_col).cast("long").alias("id"), grams.alias("grams")).where(F.size("grams") > 0)


def fuzzy_title(corpus: DataFrame, queries: DataFrame, threshold: float = 0.3,
                k: int | None = None) -> DataFrame:
    """Titles whose trigram similarity to the query is >= threshold:
    ``(query_id, doc_id, similarity)``, or with ``k`` the best ``k`` of each
    query (its own ``k`` column counts, as in ``query_limits``) with a ``rank``.

    ``threshold`` counts in thousandths and is above 0.  Ties by id.  The gram
    lists of the queries are shipped in blocks of at most ``QUERY_BLOCK_BYTES``;
    each block is one more scan of the titles."""
    ensure_package(corpus.sparkSession)
    num = int(round(threshold * 1000))
    if num < 1:
        raise ValueError("threshold must be at least 0.001")
    q = queries.where(~is_blank(F.col("q")))
    limits = None
    if k is not None:
        k, limits = query_limits(q, k)
    qg = materialize(gram_lists(q, "query_id", "q"), "query-grams")
    found = _by_blocks(qg, gram_lists(corpus, "doc_id", "title"), "grams",
                       lambda rows: _lists_of([r["id"] for r in rows], [r["grams"] for r in rows]),
                       lambda bc: _scan_counter(bc, num, k), "query_id long, doc_id long, key long")
    if k is None:
        return found.select("query_id", "doc_id", (F.col("key") / 1e6).alias("similarity"))
    w = Window.partitionBy("query_id").orderBy(F.col("key").desc(), F.col("doc_id").asc())
    ranked = found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
    return cut(ranked, limits).select("query_id", "rank", "doc_id", (F.col("key") / 1e6).alias("similarity"))


def _scan_counter(bc, num, k):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        qids, nq, grams, starts, members, _ = bc.value
        vocabulary = pa.array(grams, pa.string())
        held = (np.empty(0, np.int64),) * 3
        least = np.zeros(len(qids), dtype=np.int64)

        def out(q, doc, key):
            return pa.RecordBatch.from_arrays([pa.array(qids[q]), pa.array(doc), pa.array(key)],
                                              names=["query_id", "doc_id", "key"])

        step = max(1, _CELLS // len(qids))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                tile = batch.slice(at, step)
                ids = tile.column(0).to_numpy()
                nd = pc.list_value_length(tile.column(1)).to_numpy().astype(np.int64)
                gram = pc.fill_null(pc.index_in(tile.column(1).flatten(), value_set=vocabulary), -1).to_numpy()
                row = np.repeat(np.arange(len(ids)), nd)
                c = _shared(row[gram >= 0], gram[gram >= 0], len(ids), len(qids), starts, members)
                union = nd[:, None] + nq[None, :] - c
                i, j = np.nonzero(c * 1000 >= union * num)
                # Similarity in millionths, rounded half up.
                key = (2_000_000 * c[i, j] + union[i, j]) // (2 * union[i, j])
                if k is None:
                    yield out(j, ids[i], key)
                    continue
                keep = key >= least[j]
                held = tuple(np.concatenate(p) for p in zip(held, (j[keep], ids[i[keep]], key[keep])))
                *held, least = _best(*held, k, len(qids))
        if k is not None:
            yield out(*held)
    return run
