"""Chat formatting: tool-call linking.

Calls and results meet in a hash join on (conversation, identifier), so one
huge conversation is spread like many small ones.  Arguments are parsed as
variants and validated against the tool's schema; canonical JSON has sorted
keys and no white space (a variant keeps object keys in order).

Topological order: a call stands after every call it depends on.  Sorting by
``(level, position)`` gives that order, where ``level`` counts, along the
dependency paths, the steps to a call that isn't at an earlier position.  In a
well-formed conversation all levels are 0; otherwise levels are raised round by
round, each a join, until nothing changes.  A call whose level would exceed its
conversation's number of such steps lies on or behind a cycle and is marked.

Everything is DataFrame functions.

Edge cases: repeated calls or results of one identifier count once, the first
by position (``n_calls``, ``n_results`` tell how many there were); a call
without an identifier is linked with nothing; results without a call get a row
of their own (``orphan_result``), those without an identifier too, unless equal in position and content; dependencies on unknown calls are ignored;
arguments that aren't a JSON object are ``invalid_json``, tools without a
schema are ``unknown_tool``; nulls, empty texts and empty tables are allowed,
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import saved, within

#: Type of a field by the type of the parsed value.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL.*|DOUBLE)$", "boolean": "^BOOLEAN$",
         "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID$"}


def levels(calls: DataFrame) -> DataFrame:
    """``conv_key, call_id, level, cyclic`` for the calls whose level isn't 0.

    ``calls``: ``conv_key, call_id, position, depends_on``, identifiers unique and not null."""
    at = calls.select("conv_key", F.col("call_id").alias("dep"), F.col("position").alias("dep_at"))
    edges = saved(calls.select("conv_key", "call_id", "position", F.explode(F.array_distinct("depends_on")).alias("dep"))
                  .join(at, ["conv_key", "dep"])
                  .select("conv_key", "call_id", "dep", (F.col("dep_at") >= F.col("position")).cast("int").alias("step")), "call-edges")
    steps = edges.filter("step = 1")
    if steps.isEmpty():
        return calls.select("conv_key", "call_id", F.lit(0).alias("level"), F.lit(False).alias("cyclic")).limit(0)
    most = saved(steps.groupBy("conv_key").agg(F.count("*").alias("most")), "call-steps")
    level = saved(steps.select("conv_key", "call_id", F.lit(1).cast("long").alias("level")).distinct(), "call-levels")
    fresh = level
    while not fresh.isEmpty():
        up = edges.join(fresh.select("conv_key", F.col("call_id").alias("dep"), F.col("level").alias("below")), ["conv_key", "dep"]) \
            .groupBy("conv_key", "call_id").agg(F.max(F.col("below") + F.col("step")).alias("up")) \
            .join(most, "conv_key").select("conv_key", "call_id", F.least("up", F.col("most") + 1).alias("up"))
        both = saved(level.join(up, ["conv_key", "call_id"], "full").select(
            "conv_key", "call_id", F.greatest(F.coalesce("level", F.lit(0)), F.coalesce("up", F.lit(0))).alias("level"),
            (F.coalesce("up", F.lit(0)) > F.coalesce("level", F.lit(0))).alias("raised")), "call-levels")
        level, fresh = both.drop("raised"), both.filter("raised").drop("raised")
    return level.join(most, "conv_key").select("conv_key", "call_id", "level", (F.col("level") > F.col("most")).alias("cyclic"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call or orphan result, in order of conversation, level and position.

    ``calls``: ``conv_id, call_id, position, name, arguments, depends_on``;
    ``results``: ``conv_id, call_id, position, content``; ``schemas``:
    ``name, field, type, required``."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    call_id = F.coalesce(F.concat(F.lit("="), F.col("call_id")), F.concat(F.lit("?"), F.coalesce(F.col("position").cast("string"), F.lit("")),
                                                                        F.coalesce(F.col("arguments"), F.lit(""))))
    c = calls.withColumn("conv_key", conv).withColumn("key", call_id).groupBy("conv_key", "key").agg(
        F.min(F.struct("position", "name", "arguments", "depends_on", "conv_id", "call_id")).alias("c"), F.count("*").alias("n_calls"))
    result_id = F.coalesce(F.concat(F.lit("="), F.col("call_id")), F.concat(F.lit("!"), F.coalesce(F.col("position").cast("string"), F.lit("")),
                                                                          F.lit(" "), F.coalesce(F.col("content"), F.lit(""))))
    r = results.withColumn("conv_key", conv).withColumn("key", result_id).groupBy("conv_key", "key").agg(
        F.min(F.struct("position", "content", "conv_id", "call_id")).alias("r"), F.count("*").alias("n_results"))
    c = saved(c, "calls")
    rank = levels(c.select("conv_key", F.col("key").alias("call_id"), F.coalesce("c.position", F.lit(-1)).alias("position"),
                           F.transform(F.coalesce("c.depends_on", F.array().cast("array<string>")), lambda x: F.concat(F.lit("="), x)).alias("depends_on")))
    rows = c.join(r, ["conv_key", "key"], "full").join(rank.withColumnRenamed("call_id", "key"), ["conv_key", "key"], "left")

    fields = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("field", "type", "required"))).alias("fields"))
    fields = saved(fields, "call-schemas").withColumnRenamed("name", "tool")
    rows = rows.withColumn("v", F.try_parse_json("c.arguments"))
    rows = rows.withColumn("args", F.try_variant_get("v", "$", "map<string,variant>")).join(within(fields), F.col("c.name") == F.col("tool"), "left")

    def error(f):
        value = F.schema_of_variant(F.element_at("args", f["field"]))
        known = F.array_contains(F.map_keys("args"), f["field"])
        right = F.lit(False)
        for name, pattern in TYPES.items():
            right = right | ((f["type"] == name) & value.rlike(pattern))
        return F.when(~known, F.when(F.coalesce(f["required"], F.lit(False)), F.concat(F.lit("missing:"), f["field"]))) \
            .when(~F.coalesce(right, F.lit(False)), F.concat(F.lit("type:"), f["field"]))

    extra = F.array_sort(F.array_except(F.map_keys("args"), F.transform("fields", lambda f: f["field"])))
    errors = F.concat(F.filter(F.transform("fields", error), lambda e: e.isNotNull()),
                      F.transform(extra, lambda k: F.concat(F.lit("unknown:"), k)))
    verdict = F.when(F.col("c").isNull(), F.array().cast("array<string>")).when(F.col("args").isNull(), F.array(F.lit("invalid_json"))) \
        .when(F.col("fields").isNull(), F.array(F.lit("unknown_tool"))).otherwise(errors)
    status = F.when(F.col("c").isNull(), "orphan_result").when(F.coalesce("cyclic", F.lit(False)), "cycle") \
        .when(F.col("r").isNull(), "missing_result").when(F.col("r.position") < F.col("c.position"), "result_before_call").otherwise("linked")
    canonical = F.to_json(F.struct(F.col("v").alias("arguments"), F.coalesce("c.call_id", "r.call_id").alias("id"),
                                   F.col("c.name").alias("name"), F.col("r.content").alias("result")), {"ignoreNullFields": "false"})
    return rows.select(
        F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"), F.coalesce("c.call_id", "r.call_id").alias("call_id"),
        F.coalesce("level", F.lit(0)).cast("int").alias("level"), F.coalesce("c.position", "r.position").alias("position"),
        status.alias("status"), (F.size(verdict) == 0).alias("valid"), F.array_join(verdict, ",").alias("errors"),
        F.coalesce("n_calls", F.lit(0)).cast("int").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("int").alias("n_results"),
        canonical.alias("canonical")).orderBy("conv_id", "level", "position", "call_id")


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and schemas of a plain chat table ``conv_id, turn, role, text``.

    A user's turn is a call of the tool ``reply`` named by conversation and
    turn, which depends on the user's turn before; the assistant's next turn is
    its result."""
    name = lambda turn: F.concat_ws("_", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    calls = turns.filter("role = 'user'").select(
        "conv_id", name(F.col("turn")).alias("call_id"), F.col("turn").alias("position"), F.lit("reply").alias("name"),
        F.to_json(F.struct("turn", "text", F.length("text").alias("chars")), {"ignoreNullFields": "false"}).alias("arguments"),
        F.array(name(F.col("turn") - 2)).alias("depends_on"))
    results = turns.filter("role = 'assistant'").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))
    schemas = turns.sparkSession.createDataFrame(
        [("reply", "text", "string", True), ("reply", "turn", "integer", True), ("reply", "chars", "integer", True)],
        "name string, field string, type string, required boolean")
    return calls, results, schemas
