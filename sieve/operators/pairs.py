"""Clauses and cover density of candidate pairs, a document at a time.

A document's postings of query words meet the terms of its candidate queries
in one cogroup by ``doc_id``: postings are shuffled once and never multiplied
by queries as rows.  The helper below works on one document and expands its
words by query in arrays, a run of queries of about ``CELLS`` hits at once.

The rules are those of ``covers`` (the relational form; the tests compare
both): an occurrence stands until its item's next one ends (``sup``), and is
the latest start of its clause from ``until`` on, when all items have occurred,
it has ended itself and all that start before it are superseded.  Steps that
exceed all before, in order of their ends, are the minimal covers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .._ship import ensure_package

CELLS = 1 << 20
_STEP = 1 << 32  # above all positions
_NEVER = 2 ** 31 - 1
SCHEMA = "query_id long, doc_id long, clauses array<int>, matched boolean, score double"


def _new(*cols: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(cols[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return new


def _occurrences(item, at, offset, size, low, high):
    """``item, start, end`` of the items that occur, from the hits of their words."""
    one = size[item] == 1
    it, start = item[~one], at[~one] - offset[~one]
    key, n = np.unique(it * _STEP + start + _NEVER, return_counts=True)
    it, start = key // _STEP, key % _STEP - _NEVER
    whole = n == size[it]
    it, start = it[whole], start[whole]
    return (np.concatenate((item[one], it)), np.concatenate((at[one], start + low[it])), np.concatenate((at[one], start + high[it])))


def _covers(item, start, end, clause, query):
    """``query, start, end`` of the minimal covers; ``clause`` by item and ``query`` by clause, all items of which occur."""
    order = np.lexsort((end, item))
    item, start, end = item[order], start[order], end[order]
    first = _new(item)
    sup = np.append(np.where(first[1:], _NEVER, end[1:]), _NEVER)
    cl = clause[item]
    all_in = np.zeros(len(query), np.int64)
    np.maximum.at(all_in, cl[first], end[first])
    order = np.lexsort((start, cl))
    cl, start, end, sup = cl[order], start[order], end[order], sup[order]
    key = cl * _STEP + start
    so_far = np.concatenate(([-1], np.maximum.accumulate(cl * _STEP + sup)))
    before = so_far[np.searchsorted(key, key, "left")] - cl * _STEP  # negative in a clause before
    until = np.maximum(np.maximum(all_in[cl], end), before)
    step = until < sup
    q, start, until = query[cl[step]], start[step], until[step]
    order = np.lexsort((-start, until, q))
    q, start, until = q[order], start[order], until[order]
    best = np.concatenate(([-1], np.maximum.accumulate(q * _STEP + start)))[:-1]
    cover = q * _STEP + start > best
    return q[cover], start[cover], until[cover]


def _run(words, pos, w, terms):
    """``queries, clauses, matched, scores`` of a run of term rows, sorted by query, clause and item."""
    qid, cid, iid, neg, offset, word, n_words = terms
    lo = np.searchsorted(words, word, "left")
    n = np.searchsorted(words, word, "right") - lo
    row = np.repeat(np.arange(len(word)), n)
    hit = np.arange(len(row)) + np.repeat(lo - np.cumsum(n) + n, n)
    new_q, new_c, new_i = _new(qid), _new(qid, cid), _new(qid, cid, iid)
    item, clause, query = np.cumsum(new_i) - 1, np.cumsum(new_c) - 1, np.cumsum(new_q) - 1
    first = np.flatnonzero(new_i)
    low, high = np.minimum.reduceat(offset, first), np.maximum.reduceat(offset, first)
    of_item, not_item, of_clause = clause[first], neg[first], query[new_c]

    it, start, end = _occurrences(item[row], pos[hit], offset[row], n_words[first], low, high)
    there = np.zeros(len(first), bool)
    there[it] = True
    n_pos = np.bincount(of_item[~not_item], minlength=len(of_clause))
    pos_ok = (n_pos > 0) & (np.bincount(of_item[~not_item & there], minlength=len(of_clause)) == n_pos)
    ok = pos_ok & (np.bincount(of_item[not_item & there], minlength=len(of_clause)) == 0)
    n_q = int(new_q.sum())
    matched = np.bincount(of_clause[ok], minlength=n_q) > 0

    use = ~not_item[it] & pos_ok[of_item[it]]
    q, start, end = _covers(it[use], start[use], end[use], of_item, of_clause)
    plain = ~neg[row]
    key, at = np.unique(query[row[plain]] * _STEP + pos[hit[plain]], return_index=True)
    inverse = np.concatenate(([0.0], np.cumsum(1 / w[hit[plain]][at])))
    a, b = np.searchsorted(key, q * _STEP + start, "left"), np.searchsorted(key, q * _STEP + end, "right")
    gaps = np.maximum(end - start - (b - a - 1), 0)
    score = np.bincount(q, weights=(b - a) / (inverse[b] - inverse[a]) / (1 + gaps), minlength=n_q)
    found = np.bincount(of_clause[pos_ok], minlength=n_q)
    return qid[new_q], cid[new_c][pos_ok], found, matched, score


def document_pairs(post: pa.Table, terms: pa.Table, cells: int = CELLS) -> pa.Table:
    """One document's queries of which a clause's positive items all occur (``SCHEMA``).

    ``post``: ``doc_id, word, pos, w``; ``terms``: ``doc_id, query_id, clause_id, item_id, negated, offset, word, n_words``."""
    col = lambda t, c, kind=np.int64: t.column(c).to_numpy().astype(kind)
    words, pos, w = col(post, "word"), col(post, "pos"), col(post, "w", np.float64)
    order = np.lexsort((pos, words))
    words, pos, w = words[order], pos[order], w[order]
    names = ("query_id", "clause_id", "item_id", "negated", "offset", "word", "n_words")
    t = [col(terms, c, bool if c == "negated" else np.int64) for c in names]
    order = np.lexsort((t[4], t[2], t[1], t[0]))
    t = [c[order] for c in t]
    n = np.searchsorted(words, t[5], "right") - np.searchsorted(words, t[5], "left")
    at = np.flatnonzero(_new(t[0]))
    size = np.cumsum(np.add.reduceat(n, at)) if len(at) else at
    out = []
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + cells, "right")))
        out.append(_run(words, pos, w, [c[at[a]:at[b] if b < len(at) else None] for c in t]))
        a = b
    qid, clauses, found, matched, score = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 5
    ends = np.concatenate(([0], np.cumsum(found)))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(clauses, pa.int32()))
    doc = terms.column("doc_id")[0].as_py() if len(terms) else None
    rows = pa.table([pa.array(qid, pa.int64()), pa.array([doc] * len(qid), pa.int64()), lists, pa.array(matched, pa.bool_()), pa.array(score, pa.float64())],
                    names=["query_id", "doc_id", "clauses", "matched", "score"])
    return rows.filter(pa.array(found > 0))


def pair_scores(post: DataFrame, terms: DataFrame) -> DataFrame:
    """``SCHEMA`` for all documents: a cogroup by ``doc_id`` of ``document_pairs``' inputs."""
    ensure_package(post.sparkSession)

    def of_document(left: pa.Table, right: pa.Table) -> pa.Table:
        return document_pairs(left, right)

    return post.groupBy("doc_id").cogroup(terms.groupBy("doc_id")).applyInArrow(of_document, SCHEMA)
