"""Boolean matching and cover-density ranking for a query table.

Plan, all DataFrame operators:

1. Collection frequency of the query vocabulary only: from a stored index'
   term directory, or by a left-semi join of the postings on the distinct
   query words (broadcast behind a size check).
2. Rarest words first: per clause the two positive words of smallest
   collection frequency are its *anchors*; candidate documents hold both.
   Every match contains its clause's anchors, so nothing is lost, and
   common words never fan out over all queries.
3. The query words' postings in candidate documents meet the terms of the
   documents' candidate queries in a cogroup by ``doc_id`` (see ``pairs``), the
   only shuffle of postings: phrases (all words at ``start + offset``), clause
   checks, negation and the cover density of a document's queries are worked
   out there, so neither hits nor occurrences by query become rows.

Cover score = ``n_hits / sum(1/weight) / (1 + gaps)`` with
``gaps = (end_pos - start_pos) - (end_idx - start_idx)``.  Hits are the
positions of the query's positive words (any clause) in the document.

A clause of negated items only matches every document without them; documents
that match by such clauses alone have score 0 and rank by id after all others.
For the ranked form only the first ``k`` documents by id that such a clause
doesn't exclude are listed, found from the gaps of its posting list (see
``complement``), so no queries x corpus table arises.  A query whose positive
clauses are one word each needs no covers: its score is the sum of the words' weights.

Deviation (stated): negated words are not part of the hit list used for covers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import materialize
from .analyze import postings as build_postings
from .complement import first_free
from .limits import cut, query_limits
from .pairs import pair_scores
from .query_terms import query_terms

QK = ["query_id", "doc_id"]
DEFAULT_BROADCAST_ROWS = 5_000_000
# A clause's candidates must hold its two rarest positive words.
ANCHORS_PER_CLAUSE = 2


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting the rows; otherwise leave the join
    to the planner (sort-merge / AQE)."""
    return F.broadcast(df) if df.count() <= max_rows else df


def match_hits(post: DataFrame, qt: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, freq: DataFrame | None = None):
    """Return ``(scored, pos_ok, matched)`` for the query term table.

    ``scored (query_id, doc_id, score)`` is the cover density of every pair with
    a clause in ``pos_ok (query_id, clause_id, doc_id)``, those whose positive items all occur; ``matched``
    are the pairs with such a clause and none of its negated items.
    ``freq (term, cf)`` are known frequencies; else the postings are counted."""
    if qt.isEmpty():
        none = qt.select("query_id", "clause_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0.0).alias("score"))
        return none.select(*QK, "score"), none.select("query_id", "clause_id", "doc_id"), none.select(*QK)
    words = materialize(qt.select("term").distinct().withColumn("word", F.monotonically_increasing_id()), "words")
    words = bounded_broadcast(words, max_broadcast_rows)
    rows = materialize(post.join(words, "term").select("doc_id", "word", "pos", "w"), "word-postings")
    qt = materialize(qt.join(words, "term").drop("term"), "word-terms")
    cf = rows.groupBy("word").agg(F.count("*").alias("cf")) if freq is None else freq.join(words, "term").select("word", "cf")
    posw = qt.where(~F.col("negated"))
    a = posw.select("query_id", "clause_id", "word").distinct().join(cf, "word", "left")
    wa = Window.partitionBy("query_id", "clause_id").orderBy(F.col("cf").asc(), F.col("word").asc())
    wn = Window.partitionBy("query_id", "clause_id")
    anchors = (a.select("query_id", "clause_id", "word", F.row_number().over(wa).alias("_r"),
                        F.count("*").over(wn).alias("_nt"), F.count("cf").over(wn).alias("_known"))
               .where("_known = _nt")  # a word that occurs nowhere: the clause can't match
               .where(F.col("_r") <= ANCHORS_PER_CLAUSE)
               .select("query_id", "clause_id", "word",
                       F.least(F.col("_nt"), F.lit(ANCHORS_PER_CLAUSE)).alias("_need")))
    anchors = bounded_broadcast(materialize(anchors, "anchors"), max_broadcast_rows)
    rare = bounded_broadcast(materialize(anchors.select("word").distinct(), "anchor-words"), max_broadcast_rows)
    # a document's occurrences of a word count once before the clauses that have it fan out
    held = rows.join(rare, "word", "left_semi").groupBy("doc_id", "word").agg(F.lit(1).alias("_one"))
    cand = (held.join(anchors, "word").groupBy("query_id", "clause_id", "doc_id", "_need").agg(F.count("*").alias("_have"))
            .where(F.col("_have") == F.col("_need")).select(*QK).distinct())
    cand = materialize(cand, "candidates")
    docs = bounded_broadcast(materialize(cand.select("doc_id").distinct(), "candidate-docs"), max_broadcast_rows)
    terms = cand.join(bounded_broadcast(qt, max_broadcast_rows), "query_id")
    pairs = materialize(pair_scores(rows.join(docs, "doc_id", "left_semi"), terms), "pairs")
    return (pairs.select(*QK, "score"), pairs.select("query_id", F.explode("clauses").alias("clause_id"), "doc_id"),
            pairs.where("matched").select(*QK))


def top_k(scored: DataFrame, queries: DataFrame | None = None, k: int = 20,
          score: str = "score", higher_first: bool = True) -> DataFrame:
    """``row_number() <= k`` per query on the 6-place score, ties by id.

    The literal bound lets Spark plan a partial WindowGroupLimit before the
    shuffle; a per-query ``k`` column on ``queries`` then cuts further."""
    s = scored.withColumn(score, F.round(F.col(score), 6) + F.lit(0.0))
    order = F.col(score).desc() if higher_first else F.col(score).asc()
    w = Window.partitionBy("query_id").orderBy(order, F.col("doc_id").asc())
    kmax, limits = query_limits(queries, k)
    return cut(s.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= kmax), limits)


def word_queries(qt: DataFrame) -> DataFrame:
    """``(query_id)`` of queries whose positive clauses are one word each; the others, if any, only have negated items."""
    clauses = qt.groupBy("query_id", "clause_id").agg(F.count("*").alias("_n"), F.max("negated").alias("_some"), F.min("negated").alias("_all"))
    return clauses.groupBy("query_id").agg(F.min(F.col("_all") | ((F.col("_n") == 1) & ~F.col("_some"))).alias("_each"), F.min("_all").alias("_none")) \
        .where("_each AND NOT _none").select("query_id")


def word_scores(post: DataFrame, words: DataFrame) -> DataFrame:
    """``(query_id, doc_id, score)`` of word queries ``words (query_id, term)``: the sum of the words' weights.

    Each occurrence of a word is a cover by itself.  One shuffle, by document;
    a word's weights are summed before the queries that have it fan out."""
    vocab = bounded_broadcast(materialize(words.select("term").distinct(), "vocabulary"))
    per_doc = post.join(vocab, "term", "left_semi").select("doc_id", "term", F.col("w").cast("double").alias("w")) \
        .repartition("doc_id").groupBy("doc_id", "term").agg(F.sum("w").alias("w"))
    return per_doc.join(bounded_broadcast(words), "term").groupBy("query_id", "doc_id").agg(F.sum("w").alias("score"))


def negated_clauses(qt: DataFrame) -> DataFrame:
    """The term rows of clauses without a positive item."""
    return qt.join(qt.where(~F.col("negated")).select("query_id", "clause_id").distinct(), ["query_id", "clause_id"], "left_anti")


def excluded_by(post: DataFrame, pure: DataFrame, freq: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(clauses, excluded)``: ``query_id, clause_id, clause`` and ``clause, doc_id``.

    Purely negated clauses with equal items share one ``clause``, and so one
    list of the documents that hold an item of theirs.  The documents of a
    single word are its postings; other clauses are searched, each item as an
    alternative."""
    items = pure.groupBy("query_id", "clause_id", "item_id").agg(F.array_sort(F.collect_list(F.struct("offset", "term"))).alias("words"))
    clauses = materialize(items.groupBy("query_id", "clause_id").agg(F.array_sort(F.collect_set("words")).alias("items")), "negated-clauses")
    numbered = materialize(clauses.groupBy("items").agg(F.min(F.struct("query_id", "clause_id")).alias("clause")), "negated-distinct")
    clauses = clauses.join(numbered, "items").select("query_id", "clause_id", "clause")
    one = (F.size("items") == 1) & (F.size(F.col("items")[0]) == 1)
    words = numbered.where(one).select("clause", F.col("items")[0][0]["term"].alias("term"))
    found = post.join(bounded_broadcast(materialize(words, "negated-words")), "term").select("clause", "doc_id").distinct()
    several = materialize(numbered.where(~one).withColumn("query_id", F.monotonically_increasing_id()), "negated-several")
    rest = several.select("query_id", F.posexplode("items").alias("clause_id", "words"))
    rest = rest.select("query_id", "clause_id", F.lit(0).alias("item_id"), F.lit(False).alias("negated"), F.size("words").alias("n_words"),
                       F.explode("words").alias("w")).select("query_id", "clause_id", "item_id", "negated", "w.offset", "w.term", "n_words")
    rest = materialize(rest, "negated-items")
    if not rest.isEmpty():
        found = found.unionByName(match_hits(post, rest, freq=freq)[2].join(several, "query_id").select("clause", "doc_id"))
    return clauses, materialize(found, "excluded")


def all_without(docs: DataFrame, clauses: DataFrame, excluded: DataFrame, block: int = 1 << 16) -> DataFrame:
    """``(query_id, doc_id)``: every document that a clause doesn't exclude, by blocks of places."""
    last = ((docs.agg(F.max("place")).first()[0] or 0) - 1) // block
    if last < 0:
        return excluded.select(F.col("clause.query_id").alias("query_id"), "doc_id").limit(0)
    tries = clauses.select("query_id", "clause", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("b"))
    return tries.join(docs.select(F.floor((F.col("place") - 1) / block).alias("b"), "doc_id"), "b") \
        .join(excluded, ["clause", "doc_id"], "left_anti").select(*QK).distinct()


def search_text(corpus: DataFrame, queries: DataFrame, k: int = 20, config: str = "simple",
                plain: bool = False, ranked: bool = True, post: DataFrame | None = None) -> DataFrame:
    """Full text search: ``(query_id, rank, doc_id, score)``.

    ``ranked=False`` returns the boolean matches ``(query_id, doc_id)`` (R1)."""
    q = queries.where(~is_blank(F.col("q")))
    if post is None:
        post = build_postings(corpus, config)
    qt = materialize(query_terms(q, config=config, plain=plain))
    return search_terms(q, qt, post, k=k, ranked=ranked, corpus=corpus)


def search_terms(q: DataFrame, qt: DataFrame, post: DataFrame, k: int = 20, ranked: bool = True, freq: DataFrame | None = None,
                 docs: DataFrame | None = None, corpus: DataFrame | None = None) -> DataFrame:
    """``search_text`` of the parsed queries ``qt`` over the postings ``post``.

    ``freq (term, cf)`` and ``docs (place, doc_id)`` are what a stored index
    knows; without them words are counted and the corpus' ids numbered."""
    of_words = materialize(word_queries(qt), "word-queries")
    words = materialize(qt.where(~F.col("negated")).join(of_words, "query_id", "left_semi").select("query_id", "term").distinct(), "one-word")
    of_word = word_scores(post, words)
    pure = materialize(negated_clauses(qt), "pure-negated")
    # a purely negated clause alone needs no hits of its words
    longer = materialize(qt.join(of_words, "query_id", "left_anti")
                         .join(pure.select("query_id", "clause_id").distinct(), ["query_id", "clause_id"], "left_anti"), "longer")
    covers, pos_ok, matched = match_hits(post, longer, freq=freq)
    zero = None
    if not pure.isEmpty():
        if docs is None:
            if corpus is None:
                raise ValueError("purely negated clauses need the corpus")
            from .ingest import assign_ids
            docs = materialize(assign_ids(corpus.select("doc_id"), ["doc_id"]).select(F.col("id").alias("place"), "doc_id"), "places")
        clauses, excluded = excluded_by(post, pure, freq)
        clauses = materialize(clauses, "negated-of")
        if ranked:
            # k documents beyond those that rank by a score are enough to fill k places
            free = first_free(clauses.select("clause").distinct(), excluded, docs, query_limits(q, k)[0])
            zero = clauses.join(free, "clause").select(*QK).distinct()
        else:
            zero = all_without(docs, clauses, excluded)
        # Documents that match by a negated clause keep the covers of the query's other clauses.
        also = pos_ok.select(*QK).distinct().join(clauses, "query_id").join(excluded, ["clause", "doc_id"], "left_anti").select(*QK)
        matched = materialize(matched.union(also).distinct(), "matched")
    if not ranked:
        matched = matched.union(of_word.select(*QK))
        return matched if zero is None else matched.union(zero).distinct()
    if zero is not None:
        # A document beyond a query's best can't come back by a score of 0, as all scores of words are greater.
        of_word = top_k(of_word, q, k).drop("rank").unionByName(zero.join(of_words, "query_id", "left_semi").withColumn("score", F.lit(0.0))) \
            .groupBy(*QK).agg(F.max("score").alias("score"))
        zero = zero.join(of_words, "query_id", "left_anti").join(matched, QK, "left_anti").withColumn("score", F.lit(0.0))
    scored = of_word
    if not longer.isEmpty():
        scored = scored.unionByName(covers.join(matched, QK, "left_semi").select(*QK, "score"))
    if zero is not None:
        scored = scored.unionByName(zero)
    return top_k(scored, q, k).select("query_id", "rank", "doc_id", "score")


def phrase_items(queries: DataFrame, config: str = "simple") -> DataFrame:
    """The term rows of whole queries as one phrase each."""
    q = queries.where(~is_blank(F.col("q")))
    words = q.select("query_id", F.concat(F.lit('"'), F.regexp_replace("q", '"', " "), F.lit('"')).alias("q"))
    return materialize(query_terms(words, config=config))


def phrase_matches(post: DataFrame, queries: DataFrame, config: str = "simple") -> DataFrame:
    """Documents containing the whole query as one phrase."""
    return match_hits(post, phrase_items(queries, config))[2]
