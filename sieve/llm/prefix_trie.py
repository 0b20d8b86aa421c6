"""Prefix trie of conversations by truncation peeling.

A node of depth ``d`` is a distinct sequence of first ``d`` turns (role, text).
Conversations enter at the level where they end, equal ones as one row with
their number.  From the deepest level upwards each round merges the
conversations that end there with the nodes that survive from below, strips the
last step of the merged rows' paths and regroups them one level higher; a
node's counts and sums are aggregated in the round that finds it.

* **Steps.**  Where no conversation ends and none branches off, a node has one
  child and the same members as that child.  Such runs of turns are stripped
  in one step, so a round isn't needed for every turn of a long conversation
  but for every branching or ending on a path; the nodes inside a run are
  written out from sums along it.  Runs are found by counting distinct
  sequences by prefix.
* **Prefixes** are known by two 64-bit hashes, running XORs of hashes of
  (depth, role, text); texts are read once and travel in one shuffle.
* **Skew.**  A sequence that a third of all conversations share is one row
  after a combinable count; rounds aggregate with map-side combine.  Member
  ids of one node are hashed as a stream of sorted pieces, never held as one
  row; SHA-256 is sequential, so one task reads the pieces of one node.  A
  conversation's turns are numbered in one window, which spills.

Edge cases: rows with a null conversation take no part; null roles and texts
are empty; turns are ordered by turn (null first), role, text, so ties and
repeated rows have a fixed order and repeats stay turns; a conversation without
turns after rebuilding is a member of the root; an empty table has no nodes;
other columns are ignored; negative ids divide like Spark's ``%`` (towards
zero)."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import python_ready, saved, shared_path

#: Ids of a piece of a node's list of members.
PIECE = 512
_NONE = hashlib.sha256(b"").hexdigest()
_COLUMNS = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, x, y, size``: turns numbered from 1, two hashes of (role, text), code points of the text."""
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), F.xxhash64(F.lit(1), "role", "text").alias("x"),
                       F.xxhash64(F.lit(2), "role", "text").alias("y"), F.length("text").cast("long").alias("size"))


def rebuilt(turns: DataFrame, block: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations begun by turns of the first one of their block of ids.

    Returns the ``numbered`` turns with ``depth`` for ``pos``, and
    ``conv_id, n`` for every conversation.  A conversation takes the first
    ``crc32(id) % heads`` turns from the block's first and keeps its own after
    as many."""
    rows = saved(numbered(turns), "trie-turns")
    convs = rows.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads) \
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
    bases = convs.filter("conv_id = base").select("base", F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0).cast("long"))))
    convs = saved(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")),
                  "trie-convs")
    first = rows.filter((F.col("conv_id") % block == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    head = convs.join(first, "base").filter("pos <= h").select("conv_id", F.col("pos").alias("depth"), "x", "y", "size")
    own = rows.join(convs, "conv_id").filter("pos > h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "x", "y", "size")
    return head.unionByName(own), convs.select("conv_id", "n")


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, depth, a, b, size, last``: hashes of the first ``depth`` turns; ``last`` marks whole conversations."""
    order = W.partitionBy("conv_id").orderBy("depth")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    key = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "depth", "x", "y")).over(so_far)
    return rows.select("conv_id", "depth", key(3).alias("a"), key(4).alias("b"), "size", F.lead("depth").over(order).isNull().alias("last"))


def _streamed_sha(pieces: DataFrame) -> DataFrame:
    """``rep, sha`` of the comma-joined ``ids`` of each ``rep`` in order of ``piece``."""
    python_ready(pieces.sparkSession)

    def run(batches):
        rep = state = None
        for b in batches:
            reps, shas = [], []
            for r, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if r != rep:
                    if state is not None:
                        reps.append(rep)
                        shas.append(state.hexdigest())
                    rep, state = r, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.record_batch([pa.array(reps, pa.int64()), pa.array(shas, pa.string())], names=["rep", "sha"])
        if state is not None:
            yield pa.record_batch([pa.array([rep], pa.int64()), pa.array([state.hexdigest()])], names=["rep", "sha"])

    return pieces.select("rep", "piece", "ids").repartition("rep").sortWithinPartitions("rep", "piece").mapInArrow(run, "rep long, sha string")


def _sequences(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``rep, count, sha``: the distinct whole sequences, by their smallest conversation."""
    zero = F.lit(0).cast("long")
    ends = rows.filter("last").select("conv_id", "a", "b").unionByName(
        convs.filter("n = 0").select("conv_id", zero.alias("a"), zero.alias("b")))
    ends = saved(ends, "trie-ends")
    found = saved(ends.groupBy("a", "b").agg(F.min("conv_id").alias("rep"), F.count("*").alias("count")), "trie-sequences")
    many = ends.join(found.filter("count > 1"), ["a", "b"]) \
        .groupBy("rep", F.floor(F.col("conv_id") / PIECE).alias("piece")) \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    one = found.filter("count = 1").select("rep", "count", F.sha2(F.col("rep").cast("string").cast("binary"), 256).alias("sha"))
    more = found.filter("count > 1").select("rep", "count").join(_streamed_sha(many), "rep")
    return one.unionByName(more)


def _runs(rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """Turns of the distinct sequences with the run of turns that they lie in.

    ``rep, depth, top, ra, rb`` (the run's first depth and prefix), ``rest`` (code
    points from here to the run's end) and ``bottom`` (the run's last turn)."""
    own = saved(rows.join(sequences.select(F.col("rep").alias("conv_id")), "conv_id").withColumnRenamed("conv_id", "rep"), "trie-paths")
    shared = own.groupBy("a", "b").agg(F.count("*").alias("holders")).filter("holders > 1")
    own = own.join(shared, ["a", "b"], "left").withColumn("holders", F.coalesce("holders", F.lit(1).cast("long")))
    path = W.partitionBy("rep").orderBy("depth")
    new = F.coalesce(F.lag("holders").over(path) != F.col("holders"), F.lit(True))
    own = own.withColumns({"start": F.when(new, F.struct(F.col("depth").alias("top"), F.col("a").alias("ra"), F.col("b").alias("rb"))),
                           "bottom": F.coalesce(F.lead("holders").over(path) != F.col("holders"), F.lit(True))})
    own = own.withColumn("run", F.last("start", ignorenulls=True).over(path.rowsBetween(W.unboundedPreceding, 0))) \
        .select("rep", "depth", "size", "bottom", "run.*")
    down = W.partitionBy("rep", "top").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    return own.withColumn("rest", F.sum("size").over(down)).drop("size")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie over the turns ``conv_id, depth, x, y, size`` of the conversations ``conv_id, n``."""
    spark = rows.sparkSession
    rows = saved(prefixes(rows), "trie-prefixes")
    sequences = saved(_sequences(rows, convs), "trie-distinct")
    runs = saved(_runs(rows, sequences), "trie-runs")
    paths = runs.filter("depth = top").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("top", "ra", "rb", F.col("rest").alias("total")))).alias("path"))
    ended = sequences.join(paths, "rep", "left").select(
        F.coalesce("path", F.array().cast("array<struct<top:bigint,ra:bigint,rb:bigint,total:bigint>>")).alias("path"),
        F.col("count").alias("n"), F.col("rep").alias("conv"), "sha").withColumn("level", F.size("path"))
    at = shared_path(spark, "trie-ended")
    ended.write.partitionBy("level").parquet(at)
    ended = spark.read.schema(ended.schema).parquet(at)
    deepest = ended.agg(F.max("level")).first()[0]
    if deepest is None:
        return spark.createDataFrame([], _COLUMNS)

    zero = F.lit(0).cast("long")
    last: Column = F.try_element_at("path", F.lit(-1))
    above: Column = F.try_element_at("path", F.lit(-2))
    survivors, found = None, None
    for level in range(deepest, -1, -1):
        here = ended.filter(F.col("level") == level).select("path", "n", "conv", "sha", zero.alias("child"), zero.alias("leaves"), zero.alias("saved"))
        if survivors is not None:
            here = here.unionByName(survivors)
        merged = here.groupBy(F.coalesce(last["ra"], zero).alias("ra"), F.coalesce(last["rb"], zero).alias("rb")).agg(
            F.sum("n").alias("n"), F.min("conv").alias("conv"), F.first("path").alias("path"), F.max("sha").alias("sha"),
            F.sum("child").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("below"))
        nodes = saved(merged.withColumn("leaves", F.greatest("leaves", F.lit(1))).withColumn("level", F.lit(level)), "trie-nodes")
        found = nodes if found is None else found.unionByName(nodes)
        survivors = nodes.select(F.slice("path", 1, F.size("path") - 1).alias("path"), "n", "conv", F.lit(None).cast("string").alias("sha"),
                                 F.lit(1).cast("long").alias("child"), "leaves",
                                 (F.col("below") + (F.col("n") - 1) * last["total"]).alias("saved")) if level else None

    found = found.withColumns({"pa": F.coalesce(above["ra"], zero), "pb": F.coalesce(above["rb"], zero)}).drop("path")
    found = saved(found, "trie-found")
    ends = F.coalesce("sha", F.lit(_NONE))
    root = found.filter("level = 0").select("conv", zero.alias("depth"), F.lit(None).cast("long").alias("parent"), "n", "children", "leaves", "below", ends.alias("ends"))
    up = found.select(F.col("ra").alias("pa"), F.col("rb").alias("pb"), F.col("conv").alias("up"))
    below = found.filter("level > 0").join(up, ["pa", "pb"]).withColumnRenamed("conv", "rep")
    # a run's nodes are written out along the sequence of its smallest member
    rest = runs.join(below, ["rep", "ra", "rb"]).select(
        "rep", "depth", F.when(F.col("depth") == F.col("top"), F.col("up")).otherwise(F.col("rep")), "n",
        F.when(F.col("bottom"), F.col("children")).otherwise(F.lit(1)), "leaves", F.col("below") + (F.col("n") - 1) * F.col("rest"),
        F.when(F.col("bottom"), ends).otherwise(F.lit(_NONE)))
    return root.union(rest).toDF("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
