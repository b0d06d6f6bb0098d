"""Tool-call linking: statuses, order and canonical JSON."""

from __future__ import annotations

import json

import pytest

from plumbline.llm import toolcalls
from plumbline.llm.toolcalls import canonical, link, violation

SCHEMA = "conv_id long, turn long, role string, text string, level int, line string"
TOOLS = {"add": {"properties": {"a": {"type": "integer"}, "b": {"type": "number"}, "note": {"type": "string"}}, "required": ["a"]}}


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def linked(frame, rows):
    got = link(frame([(*r, 0, "x") for r in rows], SCHEMA), TOOLS).collect()
    return {(r.conv_id, r.call_id, r.turn): r for r in got}, got


def test_statuses_and_lines(frame):
    rows = [
        (1, 0, "assistant", call(("x", "add", {"b": 2.5, "a": 1}), ("y", "add", {"a": {"$ref": "x"}}))),
        (1, 1, "tool", result("x", 'é "q"\n')),
        (1, 1, "tool", result("y", "2")),
        (1, 2, "assistant", call(("z", "add", {"a": "no"}), ("w", "sub", {}), ("x", "add", {"a": 9}), (None, "add", {"a": 1}))),
        (1, 3, "tool", result("z", "3")),
        (1, 3, "tool", result("z", "later")),
        (1, 4, "tool", result("ghost", None)),
        (2, 0, "assistant", call(("x", "add", json.dumps({"a": 1})))),
        (3, 0, "assistant", call(("p", "add", {"a": {"$ref": "q"}}), ("q", "add", {"a": {"$ref": "p"}}), ("r", "add", {"a": {"$ref": "q"}}), ("s", "add", {"a": {"$ref": "s"}}))),
        (4, 0, "assistant", "plain tool_calls text"), (4, 1, "tool", "no json"), (4, 2, "user", None), (None, 0, "assistant", call(("x", "add", {"a": 1}))), (4, 5, "assistant", '{"tool_calls": 5}'),
    ]
    got, all_rows = linked(frame, rows)
    assert len(all_rows) == 12
    x = got[1, "x", 0]
    assert (x.status, x.level, x.result_turn) == ("ok", 0, 1)
    assert x.line == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"é \\"q\\"\\n"}'
    assert (got[1, "y", 0].status, got[1, "y", 0].level) == ("ok", 0)
    assert got[1, "z", 2].status == "invalid type:a" and json.loads(got[1, "z", 2].line)["result"] == "3"
    assert got[1, "w", 2].status == "invalid unknown_tool"
    assert got[1, "x", 2].status == "duplicate_id" and got[1, "x", 2].result_turn is None
    assert got[1, None, 2].status == "no_id" and got[1, "ghost", None].status == "no_call"
    assert got[2, "x", 0].status == "no_result"
    assert {got[3, k, 0].status for k in "pqrs"} == {"cyclic"}
    assert all(canonical(json.loads(r.line)) == r.line for r in all_rows)


def test_references_order_calls_whatever_their_turns(frame):
    rows = [(7, k, "assistant", call((f"c{k}", "add", {"a": {"$ref": f"c{k + 1}"}, "b": {"$ref": f"c{k + 2}"}}))) for k in range(6)]
    got, _ = linked(frame, rows)
    assert [got[7, f"c{k}", k].level for k in range(6)] == [5, 4, 3, 2, 1, 0]


def test_violations():
    assert violation({"a": True}, TOOLS["add"]) == "type:a"
    assert violation({"b": 1}, TOOLS["add"]) == "missing:a"
    assert violation({"a": 1, "c": 1}, TOOLS["add"]) == "unexpected:c"
    assert violation([1], TOOLS["add"]) == "arguments_not_an_object"
    assert violation({"a": 1, "b": 2, "note": "x"}, TOOLS["add"]) is None


def test_empty_table(frame):
    assert link(frame([], SCHEMA), TOOLS).collect() == []


def test_odd_texts_and_schemas_have_results(frame):
    deep = '{"tool_calls":[{"id":"d","name":"add","arguments":' + '{"a":' * 30_000 + "1" + "}" * 30_000 + "}]}"
    nested = json.dumps('{"a":' * 3_000 + "1" + "}" * 3_000)
    rows = [
        (1, 0, "assistant", '{"tool_calls":[{"id":"s","name":"add","arguments":{"a":1,"note":"\\ud800"}}]}'),
        (1, 1, "assistant", deep),
        (1, 2, "assistant", '{"tool_calls":[{"id":"n","name":"add","arguments":' + nested + "}]}"),
        (1, 3, "assistant", '{"tool_calls":[{"id":"q","name":"add","arguments":{"a":NaN}}]}'),
        (1, 4, "assistant", '{"tool_calls":[{"id":"i","name":"add","arguments":{"a":1e999}}]}'),
        (1, 5, "tool", '{"tool_call_id":"s","content":{"b":1,  "a":[2.50, null]}}'),
        (1, 6, "tool", '{"tool_call_id":"n"}'),
        (1, 7, "tool", '[1]'),
        (1, 8, "assistant", "tool_calls " + "x" * 2_000_000),
    ]
    got, all_rows = linked(frame, rows)
    assert got[1, "s", 0].line == '{"arguments":{"a":1,"note":"\\ud800"},"id":"s","name":"add","result":{"a":[2.5,null],"b":1}}'
    assert got[1, "n", 2].status == "invalid type:a" and got[1, "n", 2].line.endswith('"result":null}')
    assert got[1, "i", 4].status == "invalid arguments_not_an_object" and (1, "q", 3) not in got and (1, "d", 1) not in got
    schema = {"properties": {"a": {"type": ["integer", "null"]}, "b": {}, "c": {"type": "tuple"}, "d": {"type": "null"}}}
    assert violation({"a": None, "b": [1], "d": None}, schema) is None and violation({"a": "x"}, schema) == "type:a"
    assert violation({"c": 1}, schema) == "unsupported_schema:c" and violation({"d": 0}, schema) == "type:d"


@pytest.mark.parametrize("gathered", [100_000, 3])
def test_long_chains_cycles_and_calls_behind_them(frame, monkeypatch, gathered):
    monkeypatch.setattr(toolcalls, "GATHERED", gathered)
    n = 300 if gathered > 3 else 7
    rows = [(7, k, "assistant", call((f"c{k}", "add", {"a": {"$ref": f"c{k + 1}"}}))) for k in range(n)]
    rows += [(8, 0, "assistant", call(("p", "add", {"a": {"$ref": "q"}}))), (8, 1, "assistant", call(("q", "add", {"a": {"$ref": "p"}}))),
             (8, 2, "assistant", call(("r", "add", {"a": {"$ref": "q"}}))), (8, 3, "assistant", call(("s", "add", {"a": 1}))),
             (8, 4, "assistant", call(("t", "add", {"a": {"$ref": "s"}}))), (9, 0, "assistant", call(("u", "add", {"a": {"$ref": "nowhere"}})))]
    got, _ = linked(frame, rows)
    assert [got[7, f"c{k}", k].level for k in range(n)] == list(range(n - 1, -1, -1))
    assert {k: got[8, k, t].status for t, k in enumerate("pqrst")} == {"p": "cyclic", "q": "cyclic", "r": "cyclic", "s": "no_result", "t": "no_result"}
    assert (got[9, "u", 0].status, got[9, "u", 0].level) == ("no_result", 0)
