"""The first documents by id that a purely negated clause doesn't exclude.

Documents are numbered by id from 1 (``place``) and cut into blocks of places.
Of a clause's posting list only its counts by block are needed to find the
blocks in which its first ``k`` free places lie: blocks before the first one
without a posting, as far as free places are still missing, and that one.  In
these blocks the ``t``-th free place is ``t`` plus the number of postings ``x``
(the ``j``-th of the block) with ``x - j < t``: such postings stand before it.
So the free places come from the gaps of the sorted list; neither the
complement nor a row for each document arises."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BLOCK = 1 << 16


def first_free(clauses: DataFrame, excluded: DataFrame, docs: DataFrame, k: int, key: str = "clause", block: int = BLOCK) -> DataFrame:
    """``key, doc_id``: for each row of ``clauses (key)`` its ``k`` smallest free documents.

    ``excluded``: ``key, doc_id``, distinct; ``docs``: ``place, doc_id``, places from 1 without gaps."""
    block = max(block, k)
    total = docs.agg(F.max("place")).first()[0] or 0
    last = (total - 1) // block
    at = excluded.join(docs.select("doc_id", "place"), "doc_id") \
        .select(key, F.floor((F.col("place") - 1) / block).alias("b"), (F.col("place") - 1) % block)
    at = materialize(at.toDF(key, "b", "x"), "taken-places")
    counts = at.groupBy(key, "b").agg(F.count("*").alias("taken"))
    in_order = Window.partitionBy(key).orderBy("b")
    counts = counts.withColumn("nr", F.row_number().over(in_order) - 1)
    # blocks 0, 1, 2, ... with postings, and the first one without
    run = counts.where("b = nr").select(key, "b", "taken")
    after = run.groupBy(key).agg(F.max("b").alias("b"))
    empty = clauses.join(after, key, "left").select(key, (F.coalesce("b", F.lit(-1)) + 1).cast("long").alias("b"), F.lit(0).cast("long").alias("taken"))
    size = F.when(F.col("b") == last, F.lit(total - last * block)).otherwise(F.lit(block))
    blocks = run.unionByName(empty).where(F.col("b") <= last).withColumn("free", size - F.col("taken"))
    before = F.coalesce(F.sum("free").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    need = blocks.withColumn("need", F.least("free", F.lit(k) - before)).where("need > 0").select(key, "b", "need")
    need = materialize(need, "free-blocks")

    wanted = need.select(key, "b", F.explode(F.sequence(F.lit(1).cast("long"), F.col("need").cast("long"))).alias("t"))  # at most k numbers
    place_in_list = Window.partitionBy(key, "b").orderBy("x")
    gaps = at.join(need.select(key, "b"), [key, "b"], "left_semi") \
        .select(key, "b", (F.col("x") - F.row_number().over(place_in_list) + 1).alias("gap"))  # free places before the posting
    both = wanted.select(key, "b", (F.col("t") - 1).alias("gap"), F.lit(1).alias("asks"), "t") \
        .unionByName(gaps.select(key, "b", "gap", F.lit(0).alias("asks"), F.lit(None).cast("long").alias("t")))
    # a posting with g free places before it stands before the t-th free place if g < t, that is g <= t - 1
    skipped = F.sum(1 - F.col("asks")).over(Window.partitionBy(key, "b").orderBy("gap").rangeBetween(Window.unboundedPreceding, 0))
    free = both.withColumn("skipped", skipped).where("asks = 1") \
        .select(key, (F.col("b") * block + F.col("t") + F.col("skipped")).alias("place"))
    return free.join(docs.select("place", "doc_id"), "place").select(key, "doc_id")
