"""Linking, order, validation and canonical JSON on hand-worked cases."""

import json
import random

from sieve.llm.tool_calls import levels, link_calls

CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, position long, content string"
SCHEMAS = "name string, field string, type string, required boolean"


def test_link_validate_serialise(spark):
    calls = [(1, "a", 3, "t", '{"y": 1.5, "x": "é\\n"}', ["b"]), (1, "b", 4, "t", '{"x": 3, "z": {"k2": 1, "k1": [true, null]}}', None),
             (1, "c", 5, "t", "[1]", ["a", "zz"]), (1, "d", 6, "other", "{}", ["d"]), (2, "a", 1, "t", '{"x": ""}', []),
             (2, "a", 0, "t", '{"x": "first"}', []), (None, None, None, None, None, None)]
    results = [(1, "a", 9, "ra"), (1, "b", 2, "rb"), (2, "a", 2, None), (2, "q", 3, "lost"), (None, None, None, None)]
    schemas = [("t", "x", "string", True), ("t", "y", "number", False)]
    rows = link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), spark.createDataFrame(schemas, SCHEMAS)).collect()
    got = {(r.conv_id, r.call_id, r.status): r for r in rows}
    assert len(rows) == len(got) == 8
    a, b = got[1, "a", "linked"], got[1, "b", "result_before_call"]
    assert a.level == 1 and b.level == 0 and [r.call_id for r in rows if r.conv_id == 1][:2] == ["b", "a"]
    assert a.valid and a.canonical == '{"arguments":{"x":"é\\n","y":1.5},"id":"a","name":"t","result":"ra"}'
    assert b.errors == "type:x,unknown:z" and json.loads(b.canonical)["arguments"]["z"] == {"k1": [True, None], "k2": 1}
    assert list(json.loads(b.canonical)["arguments"]["z"]) == ["k1", "k2"]
    assert got[1, "c", "missing_result"].errors == "invalid_json" and got[1, "c", "missing_result"].level == 1
    assert got[1, "d", "cycle"].errors == "unknown_tool"
    assert got[2, "a", "linked"].n_calls == 2 and json.loads(got[2, "a", "linked"].canonical)["arguments"] == {"x": "first"}
    assert got[2, "q", "orphan_result"].n_results == 1
    empty = link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), spark.createDataFrame([], SCHEMAS))
    assert empty.count() == 0


def test_random_order_is_topological(spark):
    r = random.Random(2)
    n = 25
    order = list(range(n))
    r.shuffle(order)  # dependencies point to earlier places of this order
    rows = [("k", str(c), r.randrange(n), [str(order[j]) for j in r.sample(range(i), min(i, r.randrange(3)))]) for i, c in enumerate(order)]
    got = {x.call_id: x for x in levels(spark.createDataFrame(rows, "conv_key string, call_id string, position long, depends_on array<string>")).collect()}
    key = {c: (got[c].level if c in got else 0, p) for _, c, p, _ in rows}
    assert not any(x.cyclic for x in got.values())
    assert all(key[d] < key[c] for _, c, _, deps in rows for d in deps)


def test_results_without_identifier_stay_apart(spark):
    results = [(1, None, 2, "one"), (1, None, 2, "two"), (1, None, 5, "one"), (1, None, 5, "one"), (1, None, None, None), (2, None, 2, "one")]
    rows = link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame(results, RESULTS), spark.createDataFrame([], SCHEMAS)).collect()
    got = sorted((r.conv_id, r.position, json.loads(r.canonical)["result"], r.n_results, r.status) for r in rows if r.position is not None)
    assert got == [(1, 2, "one", 1, "orphan_result"), (1, 2, "two", 1, "orphan_result"), (1, 5, "one", 2, "orphan_result"), (2, 2, "one", 1, "orphan_result")]
    assert len(rows) == 5
