"""V1-V4: deterministic hashed bag-of-words embeddings.

Two physical forms of the same function:

* ``embed_vectors`` (V4, the one used for search) is a pure per-row
  projection: token hashes, per-dimension counts and L2 normalisation are all
  array expressions, so embedding a corpus is a narrow map with no shuffle at
  all -- the cheapest possible plan for a 100 TB scan.
* ``embed_sparse`` (V3) is the relational form, one row per (id, dim), built
  with ``explode`` + a partially aggregated ``groupBy``.  It is the form the
  SQL oracle uses and is handy for inspecting vectors.

A user embedder can replace the hashing one: ``embed_vectors(..., embedder=f)``
where ``f`` maps a text Column to an ``array<double>`` Column (a built-in
expression or a ``pandas_udf``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._ship import ensure_package
from ..functions.text import (BIGRAM_JOIN, BIGRAM_PREFIX, BIGRAM_WEIGHT,
                              FNV_OFFSET, FNV_PRIME, MASK32, UNIGRAM_WEIGHT, bigrams,
                              embed_tokens, fnv1a32)

DIMS = 128
try:
    import numpy as _np
    FNV_OFFSET_U = _np.uint64(FNV_OFFSET)
    FNV_PRIME_U = _np.uint64(FNV_PRIME)
    MASK32_U = _np.uint64(MASK32)
except ImportError:  # pragma: no cover
    pass


def embedding_text(title: Column, body: Column) -> Column:
    """S3: the reference embeds ``title + "\\n\\n" + body``."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit("")))


def _bucket(gram: Column, dims: int) -> Column:
    return F.pmod(fnv1a32(gram), F.lit(dims)).cast("int")


def hash_buckets(tokens: DataFrame, token_col: str = "token", dims: int = DIMS) -> DataFrame:
    """V2: FNV-1a hash and bucket of every token."""
    return tokens.select(token_col, fnv1a32(F.col(token_col)).alias("hash"),
                         _bucket(F.col(token_col), dims).alias("bucket"))


def gram_rows(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """One row per unigram (weight 1) and adjacent bigram (weight 0.5)."""
    toks = df.select(F.col(id_col), embed_tokens(text).alias("_toks"))
    uni = F.transform("_toks", lambda t: F.struct(t.alias("gram"), F.lit(UNIGRAM_WEIGHT).alias("w")))
    bi = F.transform(bigrams(F.col("_toks")),
                     lambda t: F.struct(t.alias("gram"), F.lit(BIGRAM_WEIGHT).alias("w")))
    return (toks.select(F.col(id_col), F.explode(F.concat(uni, bi)).alias("g"))
            .select(id_col, "g.gram", "g.w"))


def embed_sparse(df: DataFrame, id_col: str = "doc_id", text: Column | None = None,
                 dims: int = DIMS, normalize: bool = True) -> DataFrame:
    """V3 (+ V4 normalisation): ``(id, dim, value)`` for non-zero dims.

    ``explode`` keeps a document's grams in one task, so the partial
    aggregate collapses them to at most ``dims`` rows per document before the
    single shuffle on ``(id, dim)``."""
    text = F.col("text") if text is None else text
    g = gram_rows(df, id_col, text).select(id_col, _bucket(F.col("gram"), dims).alias("dim"), "w")
    sp = g.groupBy(id_col, "dim").agg(F.sum("w").alias("value"))
    if not normalize:
        return sp
    from pyspark.sql import Window
    norm = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(id_col)))
    return sp.select(id_col, "dim", (F.col("value") / norm).alias("value"))


def hashed_vector(text: Column, dims: int = DIMS) -> Column:
    """V3+V4 as one per-row expression: dense, L2-normalised ``array<double>``.

    Counts per dimension are ``size(h) - size(array_remove(h, i))`` over the
    hashed unigram / bigram arrays -- native array kernels, no explode and no
    shuffle.  An all-zero vector (no token) stays all zero."""
    toks = embed_tokens(text)
    uni = F.transform(toks, lambda t: _bucket(t, dims))
    bi = F.transform(bigrams(toks), lambda t: _bucket(t, dims))
    return _dense_from_buckets(uni, bi, dims)


def _dense_from_buckets(uni: Column, bi: Column, dims: int) -> Column:
    nu, nb = F.size(uni), F.size(bi)
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)),
        lambda i: (nu - F.size(F.array_remove(uni, i))).cast("double") * F.lit(UNIGRAM_WEIGHT)
        + (nb - F.size(F.array_remove(bi, i))).cast("double") * F.lit(BIGRAM_WEIGHT))
    return dense


def l2_norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize_df(df: DataFrame, vec_col: str, out_col: str, names: list[str]) -> DataFrame:
    """Divide by the L2 norm, computed once per row; all-zero stays zero."""
    n = df.select(*names, vec_col, l2_norm(F.col(vec_col)).alias("_norm"))
    return n.select(*names, F.when(F.col("_norm") == 0, F.col(vec_col))
                    .otherwise(F.transform(vec_col, lambda x: x / F.col("_norm"))).alias(out_col))


# ---------------------------------------------------------------------------
# Arrow-batched form of the same function (the default for corpus scans).
# The lambda form above evaluates the hash one character at a time in the
# interpreter; this helper hashes a whole Arrow batch of grams with NumPy
# column operations.  It is still a per-row function: Spark partitions the
# corpus, nothing crosses tasks, there is no shuffle.

def _fnv_continue(h0, buf, starts, lens):
    """Continue FNV-1a states ``h0`` over the byte runs ``buf[starts:starts+lens]``.

    Runs are visited longest first so that step ``j`` touches a contiguous
    prefix of them; the loop is over character positions, not tokens."""
    import numpy as np
    m = len(starts)
    if m == 0:
        return h0.copy()
    order = np.argsort(-lens, kind="stable")
    slens = lens[order]
    sst = starts[order]
    h = h0[order].copy()
    maxlen = int(slens[0])
    counts = np.searchsorted(-slens, -np.arange(maxlen), side="left")
    for j in range(maxlen):
        c = int(counts[j])
        h[:c] = ((h[:c] ^ buf[sst[:c] + j].astype(np.uint64)) * FNV_PRIME_U) & MASK32_U
    out = np.empty_like(h)
    out[order] = h
    return out


def _fnv_step(h, byte: int):
    return ((h ^ _np.uint64(byte)) * FNV_PRIME_U) & MASK32_U


#: Characters that are tokenized and hashed at once; a token costs some hundred bytes meanwhile.
SLICE_CHARS = 1 << 18
#: Rows that become Python strings and vectors at once.
PIECE_ROWS = 256


def _slices(texts, chars: int):
    """``(first, last)`` of runs of texts with at most ``chars`` characters, or a single longer one."""
    first = total = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > first and total + n > chars:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(texts):
        yield first, len(texts)


def hashed_vectors_np(texts, dims: int = DIMS, slice_chars: int = SLICE_CHARS):
    """NumPy form of V1-V4: list of texts -> (n, dims) float64, L2-normalised.

    Texts are hashed in slices of ``slice_chars``: beside the vectors the memory
    is that of a slice, however many texts a batch holds."""
    import numpy as np
    out = np.zeros((len(texts), dims), dtype=np.float64)
    for a, b in _slices(texts, slice_chars):
        out[a:b] = _hash_slice(texts[a:b], dims)
    return out


def _hash_slice(texts, dims: int):
    """The vectors of one slice.

    Tokens are found on the UTF-8 bytes of the lower-cased text: a token is a
    maximal run of ``[a-z0-9]`` bytes of length >= 2 (non-ASCII bytes are all
    >= 0x80, so they separate words exactly like ``[^a-z0-9]+``).  A bigram
    hash continues the state of ``bg:<a>_`` over the bytes of ``b``, so no
    bigram string is ever built."""
    import numpy as np
    n = len(texts)
    out = np.zeros(n * dims, dtype=np.float64)
    enc = [(t or "").lower().encode("utf-8") for t in texts]
    if n == 0:
        return out.reshape(0, dims)
    offs = np.zeros(n + 1, dtype=np.int64)
    offs[1:] = np.cumsum(np.fromiter((len(e) + 1 for e in enc), dtype=np.int64, count=n))
    buf = np.frombuffer(b" ".join(enc) + b" ", dtype=np.uint8)
    isw = ((buf >= 97) & (buf <= 122)) | ((buf >= 48) & (buf <= 57))
    edge = np.diff(np.concatenate(([0], isw.astype(np.int8), [0])))
    starts = np.flatnonzero(edge == 1)
    lens = np.flatnonzero(edge == -1) - starts
    keep = lens >= 2
    starts, lens = starts[keep], lens[keep]
    if len(starts):
        doc = np.searchsorted(offs, starts, side="right") - 1
        m = len(starts)
        h_uni = _fnv_continue(np.full(m, FNV_OFFSET_U, dtype=np.uint64), buf, starts, lens)
        bg = FNV_OFFSET_U
        for ch in BIGRAM_PREFIX.encode("ascii"):
            bg = _fnv_step(bg, ch)
        pre = _fnv_continue(np.full(m, bg, dtype=np.uint64), buf, starts, lens)
        for ch in BIGRAM_JOIN.encode("ascii"):
            pre = _fnv_step(pre, ch)
        pair = doc[:-1] == doc[1:]
        h_bi = _fnv_continue(pre[:-1][pair], buf, starts[1:][pair], lens[1:][pair])
        d64 = _np.uint64(dims)
        flat = np.concatenate((doc * dims + (h_uni % d64).astype(np.int64),
                               doc[:-1][pair] * dims + (h_bi % d64).astype(np.int64)))
        w = np.concatenate((np.full(m, UNIGRAM_WEIGHT), np.full(len(h_bi), BIGRAM_WEIGHT)))
        out += np.bincount(flat, weights=w, minlength=n * dims)
    out = out.reshape(n, dims)
    norm = np.sqrt((out * out).sum(axis=1))
    nz = norm > 0
    out[nz] = out[nz] / norm[nz, None]
    return out


def _embedded(batches, dims: int, names: list[str], out_col: str):
    """The columns ``names`` and the vector of the last column, ``PIECE_ROWS`` rows at a time.

    A Spark batch has up to 10,000 rows; beside it a task holds the texts,
    vectors and result of one piece only."""
    import numpy as np
    import pyarrow as pa
    for b in batches:
        for at in range(0, b.num_rows, PIECE_ROWS):
            piece = b.slice(at, PIECE_ROWS)
            m = hashed_vectors_np(piece.column(piece.num_columns - 1).to_pylist(), dims)
            vec = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * dims, pa.int32()), pa.array(m.ravel()))
            yield pa.record_batch([*piece.columns[:-1], vec], names=[*names, out_col])


def embed_vectors(df: DataFrame, id_col: str = "doc_id", text: Column | None = None,
                  dims: int = DIMS, out_col: str = "vec",
                  embedder: Callable[[Column], Column] | None = None,
                  keep: list[str] | None = None, method: str = "arrow") -> DataFrame:
    """Add an ``array<double>`` embedding column; narrow, no shuffle.

    ``method='arrow'`` (default) hashes Arrow batches with NumPy;
    ``method='native'`` is the same function as built-in array expressions
    (token arrays materialised once, then reused by the counting lambdas).
    ``embedder`` replaces the hashing embedder altogether."""
    text = F.col("text") if text is None else text
    keep = keep or []
    cols = [F.col(id_col)] + [F.col(c) for c in keep]
    if embedder is not None:
        return df.select(*cols, embedder(text).cast("array<double>").alias(out_col))
    names = [id_col] + keep
    if method == "arrow":
        ensure_package(df.sparkSession)
        rows = df.select(*cols, text.cast("string").alias("_text"))
        schema = T.StructType([rows.schema[n] for n in names]).add(out_col, T.ArrayType(T.DoubleType()))
        return rows.mapInArrow(lambda batches: _embedded(batches, dims, names, out_col), schema)
    t = df.select(*cols, embed_tokens(text).alias("_toks"))
    h = t.select(*names,
                 F.transform("_toks", lambda x: _bucket(x, dims)).alias("_uni"),
                 F.transform(bigrams(F.col("_toks")), lambda x: _bucket(x, dims)).alias("_bi"))
    d = h.select(*names, _dense_from_buckets(F.col("_uni"), F.col("_bi"), dims).alias("_raw"))
    return l2_normalize_df(d, "_raw", out_col, names)


def embed_corpus(corpus: DataFrame, dims: int = DIMS, embedder=None,
                 method: str = "arrow") -> DataFrame:
    """Corpus ``(doc_id, title, body, ...)`` -> ``(doc_id, vec)``."""
    return embed_vectors(corpus, "doc_id", embedding_text(F.col("title"), F.col("body")),
                         dims=dims, embedder=embedder, method=method)


def embed_queries(queries: DataFrame, dims: int = DIMS, embedder=None,
                  method: str = "arrow") -> DataFrame:
    """Queries ``(query_id, q, k)`` -> ``(query_id, k, vec)``."""
    return embed_vectors(queries, "query_id", F.col("q"), dims=dims, keep=["k"],
                         embedder=embedder, method=method)
