"""Web-search query strings -> terms in disjunctive normal form.

Grammar (the web-search syntax has no parentheses, so it is already DNF):

* bare words are ANDed,
* ``"..."`` is a phrase (an unterminated quote runs to the end),
* a stand-alone ``or`` (any case) between two operands separates clauses; elsewhere it is a word,
* a leading ``-`` negates a word or a phrase,
* a word chunk that analyses to several words (``b-tree``) is a phrase,
* chunks with no word are dropped; the parser never fails.

Output ``query_terms(query_id, clause_id, item_id, negated, offset, term,
n_words)``: one row per word of each item; ``offset`` is the word's place in
its phrase (gaps left by dropped stop words are kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_tokens

CHUNK_PATTERN = r'-?"[^"]*"?|[^\s"]+'


def query_terms(queries: DataFrame, config: str = "simple", plain: bool = False) -> DataFrame:
    """``queries(query_id, q, ...)`` -> DNF term table.

    ``plain=True`` is T6: operators are ignored and every word is one AND
    item (one clause)."""
    if plain:
        w = queries.select("query_id", F.posexplode(word_tokens(F.col("q"))).alias("item_id", "term"))
        w = w.select("query_id", F.lit(0).alias("clause_id"), F.col("item_id").cast("int"),
                     F.lit(False).alias("negated"), F.lit(0).alias("offset"), "term",
                     F.lit(1).alias("n_words"))
        return _analyse(w, config)
    ch = queries.select("query_id", F.posexplode(
        F.regexp_extract_all(F.coalesce(F.col("q"), F.lit("")), F.lit(CHUNK_PATTERN), 0))
        .alias("item_id", "chunk"))
    # `or` separates clauses only between two operands: of several in a row every second one is a word,
    # and so is one that begins or ends the string
    in_order = Window.partitionBy("query_id").orderBy("item_id")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    named = F.lower(F.col("chunk")) == "or"
    ch = ch.withColumns({"named": named, "run": F.sum((~named).cast("int")).over(so_far), "last": F.lead("item_id").over(in_order).isNull()})
    nr = F.row_number().over(Window.partitionBy("query_id", "run", "named").orderBy("item_id"))
    between = (nr - (F.col("run") == 0).cast("int")) % 2 == 1
    ch = ch.withColumn("is_or", F.col("named") & between & ~F.col("last"))
    ch = ch.select("query_id", F.col("item_id").cast("int"), "chunk", "is_or", F.sum(F.col("is_or").cast("int")).over(so_far).cast("int").alias("clause_id"))
    items = ch.where(~F.col("is_or")).select(
        "query_id", "clause_id", "item_id",
        F.col("chunk").startswith("-").alias("negated"),
        word_tokens(F.regexp_replace("chunk", r'^-|"', "")).alias("words"))
    rows = items.select("query_id", "clause_id", "item_id", "negated",
                        F.size("words").alias("n_words"),
                        F.posexplode("words").alias("offset", "term"))
    rows = rows.select("query_id", "clause_id", "item_id", "negated",
                       F.col("offset").cast("int"), "term", F.col("n_words").cast("int"))
    return _analyse(rows, config)


def _analyse(rows: DataFrame, config: str) -> DataFrame:
    if config == "simple":
        return rows
    from .stem import analyse_query_rows
    return analyse_query_rows(rows)


def query_lexemes(qt: DataFrame) -> DataFrame:
    """Distinct query lexemes (any sign) per query, sorted."""
    return qt.groupBy("query_id").agg(F.array_sort(F.collect_set("term")).alias("query_lexemes"))


def parsed_query_text(qt: DataFrame) -> DataFrame:
    """Text form of the parsed query: ``'a' & 'b' <-> 'c' | !'d'``.

    Items are joined with `` & `` inside a clause and clauses with `` | ``;
    phrase words with ``<->`` (``<N>`` across a gap)."""
    w = Window.partitionBy("query_id", "clause_id", "item_id").orderBy("offset")
    words = qt.select("*", F.lag("offset").over(w).alias("_prev"))
    sep = F.when(F.col("_prev").isNull(), F.lit("")).when(
        F.col("offset") - F.col("_prev") == 1, F.lit(" <-> ")).otherwise(
        F.concat(F.lit(" <"), (F.col("offset") - F.col("_prev")).cast("string"), F.lit("> ")))
    words = words.select("query_id", "clause_id", "item_id", "negated", "offset",
                         F.concat(sep, F.lit("'"), F.col("term"), F.lit("'")).alias("piece"))
    item = words.groupBy("query_id", "clause_id", "item_id", "negated").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "piece"))),
                                 lambda s: s["piece"]), "").alias("txt"),
        F.count("*").alias("_n"))
    item = item.select("query_id", "clause_id", "item_id", F.concat(
        F.when(F.col("negated"), F.lit("!")).otherwise(F.lit("")),
        F.when((F.col("_n") > 1) & F.col("negated"), F.concat(F.lit("( "), "txt", F.lit(" )")))
        .otherwise(F.col("txt"))).alias("txt"))
    cl = item.groupBy("query_id", "clause_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "txt"))),
                                 lambda s: s["txt"]), " & ").alias("txt"))
    return cl.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("clause_id", "txt"))),
                                 lambda s: s["txt"]), " | ").alias("parsed_query"))
