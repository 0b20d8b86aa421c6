"""Mixing sources to target weights: a time-varying curriculum.

Every source has a weight schedule over training time 0..1, given as knots and
linear in between.  Its integral is the source's weight in the mix.  Targets
share ``share`` of all words by weight; a target stops at ``cap`` times its
source's size and the excess is shared again by weight until none is above
(the water level is found with running sums over the table of sources).

The documents of a source stand in a fixed pseudo-random order (md5 of the id)
and are taken in passes until the target is met.  A copy in the middle of the
source's cumulative demand at share ``u`` gets the training time at which the
integrated schedule has spent ``u`` of its weight (the inverse of the
cumulative demand, a quadratic in each piece).  Sorting by time is a range sort.

Everything is DataFrame functions.  Running sums over a source are taken in two
steps, within buckets of its order (about ``BUCKET_ROWS`` rows) and over the
buckets, so a source that holds a third of all rows is spread over many tasks.
The table of sources is joined by broadcast only behind a count.

Edge cases: a null or blank text has size 0 and is never taken; a null source
is a source of its own, last in order; a null id is ordered like an empty one;
equal rows are ordered arbitrarily among themselves, which changes nothing;
sources of size 0 have target 0; a source without a schedule or with weight 0
has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import WORD, saved, within

#: Aimed-at rows of a bucket of a source's order.
BUCKET_ROWS = 5_000


def words(text: Column) -> Column:
    """Number of runs other than U+0020 and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null: null and the empty string differ."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def cyclic_schedule(sources: DataFrame, weights=(5.0, 2.0, 1.0), tilt=(-0.5, 0.0, 0.5)) -> DataFrame:
    """``key, knots`` for a table with a ``source`` column of distinct values.

    Sources by code point, null last, get ``weights`` in turn; a source's
    schedule falls or rises in time by its ``tilt`` with the weight as mean."""
    place = (F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (place + 1).cast("int"))
    knot = lambda t, sign: F.struct(F.lit(float(t)).alias("t"),
                                    (pick(weights) * (1 + sign * pick(tilt))).alias("w"))
    return sources.select(source_key(F.col("source")).alias("key"), F.array(knot(0, -1), knot(1, 1)).alias("knots"))


def integrated(schedule: DataFrame) -> DataFrame:
    """``key, weight, pieces``: the integral of the schedule and its pieces with cumulative shares ``c1..c2``."""
    k = F.col("knots")
    piece = lambda i: F.struct(k[i].t.alias("t1"), k[i + 1].t.alias("t2"), k[i].w.alias("w1"), k[i + 1].w.alias("w2"),
                               ((k[i + 1].t - k[i].t) * (k[i].w + k[i + 1].w) / 2).alias("area"))
    raw = schedule.filter(F.size("knots") > 1).withColumn("raw", F.transform(F.sequence(F.lit(0), F.size("knots") - 2), piece))
    upto = lambda n: F.aggregate(F.slice("raw", 1, n), F.lit(0.0), lambda a, p: a + p["area"])
    whole = F.greatest(upto(F.size("raw")), F.lit(0.0))
    pieces = F.transform("raw", lambda p, i: p.withField("c1", upto(i) / F.col("weight")).withField("c2", upto(i + 1) / F.col("weight")))
    return raw.withColumn("weight", whole).select("key", "weight", F.when(F.col("weight") > 0, pieces).alias("pieces"))


def targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """Add ``target`` to a table of sources ``(key, source_size, weight)``."""
    everything = W.partitionBy()
    limit = F.col("source_size") * F.lit(float(cap))
    ratio = F.when(F.col("weight") > 0, limit / F.col("weight"))
    rows = sources.withColumn("limit", F.when(F.col("weight") > 0, limit).otherwise(0.0)).withColumn("ratio", ratio)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    before = W.orderBy(F.col("ratio").asc_nulls_last(), "key").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.select("*", (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))).alias("left"),
                       (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("rest"),
                       F.row_number().over(W.orderBy(F.col("ratio").asc_nulls_last(), "key")).alias("place"))
    level = F.when((F.col("rest") > 0) & (F.col("weight") > 0), F.col("left") / F.col("rest"))
    rows = rows.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)
    rows = rows.withColumn("water", first)
    open_ = F.col("water").isNotNull() & (F.col("place") >= F.col("water.place"))
    return rows.withColumn("target", F.when(F.col("weight") <= 0, 0.0)
                           .when(open_, F.least(F.col("limit"), F.col("water.level") * F.col("weight"))).otherwise(F.col("limit"))) \
        .drop("limit", "ratio", "left", "rest", "place", "level", "water")


def _given(value: Column, of) -> Column:
    """``of(value)``, with the value worked out once however often ``of`` uses it."""
    return F.transform(F.array(value), of)[0]


def training_time(u: Column, pieces: Column, weight: Column) -> Column:
    """Inverse of the cumulative demand: the time at which share ``u`` of the weight is spent."""
    def inverse(u: Column, p: Column) -> Column:
        spent = F.greatest((u - p["c1"]) * weight, F.lit(0.0))
        a, b = (p["w2"] - p["w1"]) / (2 * (p["t2"] - p["t1"])), p["w1"]
        under = lambda spent: b + F.sqrt(F.greatest(b * b + 4 * a * spent, F.lit(0.0)))
        return _given(spent, lambda spent: _given(under(spent), lambda under: F.least(
            p["t2"], p["t1"] + F.when(under > 0, 2 * spent / under).otherwise(0.0))))

    return _given(u, lambda u: _given(F.element_at(F.filter(pieces, lambda x: u <= x["c2"] + 1e-12), 1), lambda p: inverse(u, p)))


def curriculum(docs: DataFrame, schedule=None, share: float = 1.5, cap: float = 2.0, whole: bool = False,
               id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id, source, size, mark, source_size, target, taken, copies`` for every row of ``docs``.

    ``schedule`` is a table ``(key, knots)`` or a function from the table of
    sources to one (default ``cyclic_schedule``).  ``copies`` holds, for each
    pass that takes words of the document, ``(pass, words, position)``.  With
    ``whole`` a copy is taken whole or not at all (its middle decides), else
    the copy at the target's edge is taken in part.  ``mark`` is a hash of the
    text."""
    rows = saved(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("mark"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("ord")),
        "mix-rows").withColumn("key", source_key(F.col("source")))
    sources = saved(rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                            F.count("*").alias("n")), "mix-sources")
    make = schedule if callable(schedule) else (lambda s: schedule) if schedule is not None else cyclic_schedule
    plan = integrated(make(sources)).join(sources.drop("source"), "key", "right").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    plan = saved(targets(plan, share, cap).withColumn("goal", F.round("target").cast("long"))
                 .withColumn("buckets", F.ceil(F.col("n") / bucket_rows)), "mix-plan")

    part = F.conv(F.substring("ord", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows = rows.join(within(plan), "key").withColumn("bucket", F.floor(part * F.col("buckets")))
    inside = W.partitionBy("key", "bucket").orderBy("ord", "doc_id", "size", "mark").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.select("key", "bucket", F.coalesce(F.sum("words").over(
        W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["key", "bucket"])
    start = F.col("before") + F.col("inner")

    def copy(p: int) -> Column:
        at = start + F.col("source_size") * p
        left = F.least(F.greatest(F.col("goal") - at, F.lit(0)), F.col("size"))
        if whole:
            left = F.when(2 * (F.col("goal") - at) >= F.col("size"), F.col("size")).otherwise(0)
        u = F.least((at + left / 2) / F.col("goal"), F.lit(1.0))
        return F.struct(F.lit(p).alias("pass"), left.cast("long").alias("words"),
                        F.when(left > 0, training_time(u, F.col("pieces"), F.col("weight"))).alias("position"))

    copies = F.filter(F.array(*[copy(p) for p in range(math.ceil(cap))]), lambda c: c["words"] > 0)
    return rows.withColumn("copies", copies).select(
        "doc_id", "source", "size", "mark", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"), "copies")


def mixed(docs: DataFrame, schedule=None, share: float = 1.5, cap: float = 2.0, id_col: str = "doc_id",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: ``docs`` with every taken copy of a document, whole, in training order.

    Of rows equal in id, source and text as many are taken as the plan takes
    of them; which of them is arbitrary."""
    plan = curriculum(docs, schedule, share, cap, True, id_col, source_col, text_col)
    plan = saved(plan.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("mark").alias("_mark"), F.col("copies").alias("_copies")),
        "mix-copies").filter(F.size("_copies") > 0)  # the filter stands behind the table, else the copies are worked out twice
    names = ["_id", "_source", "_mark"]
    keyed = docs.withColumns({"_id": docs[id_col], "_source": docs[source_col].cast("string"), "_mark": F.xxhash64(docs[text_col])})
    same = lambda a, b: a._id.eqNullSafe(b._id) & a._source.eqNullSafe(b._source) & (a._mark == b._mark)

    def joined(rows: DataFrame, taken: DataFrame) -> DataFrame:
        on = same(rows, taken) & (rows._nr == taken._nr) if "_nr" in rows.columns else same(rows, taken)
        return rows.join(taken, on).select(*[rows[c] for c in docs.columns], rows._mark, "_copies")

    again = saved(keyed.groupBy(*names).count().filter("count > 1").select(*names), "mix-again")
    if again.isEmpty():
        both = joined(keyed, plan)
    else:
        one = lambda rows: rows.join(within(again), same(rows, again), "left_anti")
        many = lambda rows, name: _numbered(rows.join(within(again), same(rows, again), "left_semi"), names, name)
        both = joined(one(keyed), one(plan)).unionByName(joined(many(keyed, "mix-equal-rows"), many(plan, "mix-equal-copies")))
    return both.withColumn("_copy", F.explode("_copies")).orderBy("_copy.position", "_mark", "_copy.pass").select(*docs.columns)


def _numbered(rows: DataFrame, names: list[str], name: str) -> DataFrame:
    """Add ``_nr``: rows equal in ``names`` numbered from 0.

    Numbers are given inside the parts that the rows are read in, and moved by
    the counts of the parts before, so a large group is spread over tasks."""
    rows = saved(rows.withColumn("_part", F.spark_partition_id()), name)
    counts = rows.groupBy(*names, "_part").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_before", F.sum("_n").over(W.partitionBy(*names).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)))
    counts = saved(counts.select(*[F.col(c).alias(f"{c}2") for c in names], F.col("_part").alias("_part2"),
                                 F.coalesce("_before", F.lit(0)).alias("_before")), f"{name}-counts")
    inner = F.row_number().over(W.partitionBy(*names, "_part").orderBy("_mark")) - 1
    equal = F.col("_part") == F.col("_part2")
    for c in names:
        equal = equal & F.col(c).eqNullSafe(F.col(f"{c}2"))
    return rows.withColumn("_inner", inner).join(within(counts), equal) \
        .withColumn("_nr", F.col("_inner") + F.col("_before")).drop("_part", "_part2", "_inner", "_before", *[f"{c}2" for c in names])
