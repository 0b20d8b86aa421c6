"""R2: cover density (Clarke, Cormack & Tudhope) by windows over change points.

For one query and document let every occurrence of an item stand for the time
from its own end until the next occurrence of the item ends (``sup``).  At a
position ``e`` each item has one standing occurrence, and the latest start of a
window that ends at ``e`` and satisfies a clause is the smallest start of the
clause's standing occurrences.  That start is a step function of ``e``.  The
step of an occurrence ``i`` begins when

* every item of the clause has occurred (``all_in``),
* ``i`` itself has ended, and
* all occurrences that start before ``i`` are superseded (the greatest ``sup``
  among them),

and it exists if that is before ``i`` is superseded.  (An earlier start that
hasn't ended yet does no harm to the rule: its item's last occurrence starts
earlier still and is superseded only when it ends.)  So a clause's steps need
one look at each occurrence, with a ``lead`` by item and a running maximum in
order of starts, instead of a table of positions by items.

A query's function is the greatest of its clauses'; merging their steps in
order and keeping those that exceed all before gives the minimal covers.
Cover score: ``n_hits / sum(1 / weight) / (1 + gaps)``.

Hits and occurrences of a pair meet in one shuffle on ``(query_id, doc_id)``;
every window below partitions by the pair and more."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAIR = ["query_id", "doc_id"]
_NEVER = 2 ** 31 - 1


def cover_scores(hits: DataFrame, occurrences: DataFrame) -> DataFrame:
    """``query_id, doc_id, score`` for every pair with hits.

    ``hits``: ``query_id, doc_id, pos, w``, each position once; ``occurrences``:
    ``query_id, doc_id, clause_id, item_id, start, end, n_pos`` with positions
    that are hits, ``n_pos`` the number of the clause's items."""
    none = F.lit(None).cast("int")
    num = lambda c: F.col(c).cast("int").alias(c)
    rows = hits.select(*PAIR, num("pos").alias("at"), F.col("w").cast("double").alias("w"), *[none.alias(c) for c in ("clause_id", "item_id", "end", "n_pos")]) \
        .unionByName(occurrences.select(*PAIR, num("start").alias("at"), F.lit(None).cast("double").alias("w"), *map(num, ("clause_id", "item_id", "end", "n_pos"))))
    rows = rows.repartition(*PAIR)
    is_hit = F.col("w").isNotNull()

    # hits up to the start, and the sum of their inverse weights
    upto = Window.partitionBy(*PAIR).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    here = Window.partitionBy(*PAIR).orderBy("at").rangeBetween(0, 0)
    rows = rows.withColumns({"n_start": F.count("w").over(upto), "inv_start": F.sum(1 / F.col("w")).over(upto), "w_start": F.max("w").over(here)})

    item = Window.partitionBy(*PAIR, "clause_id", "item_id").orderBy("end")
    rows = rows.withColumns({"sup": F.coalesce(F.lead("end").over(item), F.lit(_NEVER)), "first": F.when(F.lag("end").over(item).isNull(), F.col("end"))})
    clause = Window.partitionBy(*PAIR, "clause_id")
    rows = rows.withColumns({"all_in": F.max("first").over(clause), "present": F.count("first").over(clause)})
    before = clause.orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("until", F.greatest("all_in", "end", F.max("sup").over(before)))
    step = ~is_hit & (F.col("present") == F.col("n_pos")) & (F.col("until") < F.col("sup"))

    # steps in order of their ends, among the hits
    rows = rows.filter(is_hit | step).withColumn("to", F.when(is_hit, F.col("at")).otherwise(F.col("until")))
    upto = Window.partitionBy(*PAIR).orderBy("to").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"n_end": F.count("w").over(upto), "inv_end": F.sum(1 / F.col("w")).over(upto)})
    earlier = Window.partitionBy(*PAIR, is_hit).orderBy("to", F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("best", F.max("at").over(earlier))
    cover = ~is_hit & (F.col("best").isNull() | (F.col("at") > F.col("best")))
    span = F.col("n_end") - F.col("n_start")
    gaps = F.greatest(F.col("to") - F.col("at") - span, F.lit(0))
    score = (span + 1) / (F.col("inv_end") - F.col("inv_start") + 1 / F.col("w_start")) / (1 + gaps)
    return rows.groupBy(*PAIR).agg(F.sum(F.when(cover, score).otherwise(F.lit(0.0))).alias("score"))
