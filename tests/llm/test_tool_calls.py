import json

import pytest

from sensorlake.llm import tool_calls as tc

SCHEMAS = {"f": {"required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}}}},
           "g": {"additionalProperties": False, "properties": {"s": {"type": "string", "maxLength": 3}}}}


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), c, strict=False)) for c in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, id string")
    return {(r["conv_id"], r["call_id"], r["turn"], r["status"]): r for r in tc.link_tool_calls(df.repartition(3), SCHEMAS).collect()}


def test_statuses_levels_and_records(spark):
    rows = [
        (1, 0, "user", "just {text}"), (1, 1, "assistant", call(("a", "f", {"x": 1, "b": {"z": 1, "é": [1, 2.5]}}), ("b", "g", {"s": "ok"}, ["a"]), ("c", "f", {"x": 2}, ["a", "b"]))),
        (1, 2, "tool", result("a", {"k": 2, "j": "\n\""})), (1, 3, "tool", result("b", None)), (1, 4, "tool", result("a", "second")), (1, 5, "tool", result("zz", 1)),
        (1, 6, "assistant", call(("a", "f", {"x": 9}), ("d", "f", {"x": -1}), ("e", "h", {}), ("h", "f", "no"), (None, "f", {"x": 1}))),
        (1, 7, "assistant", call(("p", "f", {"x": 1}, ["q"]), ("q", "f", {"x": 1}, ["p"]), ("r", "f", {"x": 1}, ["gone"]))),
        (2, 0, "assistant", call(("a", "f", {"x": 1}))), (2, 1, None, None), (2, 2, "tool", ""), (2, 3, "assistant", "{broken"), (2, 4, "tool", "[1]"), (2, 5, "assistant", '{"tool_calls":[3]}'),
        (None, None, "assistant", call((7, "g", {}))), (None, 3, "tool", result(7, True)), (3, 0, "assistant", "{" * 100000),
    ]
    got = run(spark, rows)
    state = {(k[0], k[1], k[2]): (k[3], r["level"], r["n_results"]) for k, r in got.items()}
    assert state == {
        (1, "a", 1): ("ok", 0, 2), (1, "b", 1): ("ok", 1, 1), (1, "c", 1): ("missing_result", 2, 0), (1, "zz", 5): ("orphan_result", None, 1),
        (1, "a", 6): ("duplicate_id", None, 0), (1, "d", 6): ("invalid_arguments", 0, 0), (1, "e", 6): ("unknown_tool", 0, 0), (1, "h", 6): ("malformed", None, 0),
        (1, None, 6): ("malformed", None, 0), (1, "p", 7): ("cyclic", None, 0), (1, "q", 7): ("cyclic", None, 0), (1, "r", 7): ("missing_dependency", 0, 0),
        (2, "a", 0): ("missing_result", 0, 0), (2, None, 5): ("malformed", None, 0), (None, "7", None): ("ok", 0, 1)}
    assert got[(1, "a", 1, "ok")]["record"] == '{"arguments":{"b":{"z":1,"é":[1,2.5]},"x":1},"id":"a","name":"f","result":{"j":"\\n\\"","k":2},"status":"ok"}'
    assert all(tc.canonical(json.loads(r["record"])) == r["record"] for r in got.values())


def test_empty_and_plain_text(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 0, "user", "hello"), (1, 1, "assistant", "x" * 200000)]) == {}


def test_long_chain_hot_conversation_and_copies(spark):
    rows = [(5, 0, "assistant", call(*[(f"n{i}", "f", {"x": i}, [f"n{i - 1}"] if i else []) for i in range(12)]))]
    rows += [(5, t, "assistant", call((f"m{t}", "f", {"x": t}))) for t in range(1, 300)] + [(5, t, "tool", result(f"m{t}", t)) for t in range(1, 300)]
    rows += [(5, 400, "assistant", call(("twice", "f", {"x": 1})))] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = tc.link_tool_calls(df, SCHEMAS).collect()
    assert {r["call_id"]: r["level"] for r in got if r["call_id"][0] == "n"} == {f"n{i}": i for i in range(12)}
    assert sum(r["status"] == "ok" for r in got) == 299 and sum(r["call_id"] == "twice" for r in got) == 3


@pytest.mark.parametrize(("value", "schema", "want"), [
    (1, {"type": "integer"}, True), (1.0, {"type": "integer"}, True), (1.5, {"type": "integer"}, False), (True, {"type": "integer"}, False),
    (True, {"type": "boolean"}, True), (None, {"type": "null"}, True), ("é", {"maxLength": 1}, True), ([1, "a"], {"items": {"type": "number"}}, False),
    ({"a": 1}, {"required": ["b"]}, False), ({"a": 1}, {"additionalProperties": False}, False), (5, {"enum": [1, 5]}, True), (5, {"maximum": 4}, False)])
def test_schema_subset(value, schema, want):
    assert tc.fits(value, schema) is want


def test_query_matches_sql(spark):
    import duckdb

    from sensorlake.llm.queries import LLM_ORACLE_SQL, op8_tool_calls

    sf = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    order = ["conv_id", "turn", "call_id", "name", "status", "level", "n_results", "record"]
    want = sorted((tuple(r) for r in duckdb.sql(f"SELECT {', '.join(order)} FROM ({LLM_ORACLE_SQL['op8_tool_calls']})").fetchall()), key=str)
    got = sorted((tuple(r[c] for c in order) for r in op8_tool_calls(spark, sf).collect()), key=str)
    assert {r[4] for r in got} >= {"ok", "missing_result"} and got == want


def test_numbers_and_surrogates_without_json_form(spark):
    raw = lambda args: '{"tool_calls":[{"id":"a","name":"f","arguments":' + args + "}]}"
    big = "9" * 400
    rows = [(1, 0, "assistant", raw('{"x":' + big + "}")), (2, 0, "assistant", raw('{"x":NaN}')), (3, 0, "assistant", raw('{"x":1e999}')),
            (4, 0, "assistant", raw('{"x":1,"s":"\\ud800-\\ud83d\\ude00"}')), (5, 0, "assistant", raw('{"x":1}').replace('"a"', '"\\udc00"')),
            (6, 0, "assistant", raw('{"x":1.5}')), (7, 0, "assistant", raw('{"x":1}')), (7, 1, "tool", '{"tool_call_id":"a","content":[Infinity]}')]
    got = {k[0]: (k[1], k[3], r["record"]) for k, r in run(spark, rows).items()}
    assert got[1][1] == "missing_result" and f'{{"x":{big}}}' in got[1][2]
    assert got[2][1] == got[3][1] == "malformed" and got[6][1] == "invalid_arguments"
    assert got[4][1] == "missing_result" and '"s":"\ufffd-\U0001f600"' in got[4][2]
    assert got[5][0] == "\ufffd" and got[7][1] == "ok" and '"result":null' in got[7][2]
