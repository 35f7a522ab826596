import json

from loanlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, kind string, json string"
SCHEMAS = {"reply": {"text": "string"}, "add": {"a": "integer", "b": "number", "note": "string?"}}


def run(spark, rows, schemas=SCHEMAS):
    frame = spark.createDataFrame([(*r, "k", "j") for r in rows], SCHEMA)
    out = chat.format_chats(frame, schemas).collect()
    return sorted(out, key=lambda r: (r.conv_id is not None, r.conv_id, r.position))


def call(*calls):
    return json.dumps({"tool_calls": list(calls)})


def test_plain_turns(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", 'a "q"\n\té'), (1, 2, "assistant", "b"), (1, 3, "user", None), (2, 5, "assistant", ""), (1, 4, "other", None)]
    out = run(spark, rows)
    assert [(r.conv_id, r.turn, r.kind, r.linked, r.level, r.valid, r.position) for r in out] == [
        (1, 0, "message", False, 0, True, 0), (1, 1, "call", True, 0, True, 1), (1, 2, "result", True, 1, True, 2),
        (1, 3, "call", False, 0, False, 3), (1, 4, "message", False, 0, True, 4), (2, 5, "result", False, 0, True, 0),
    ]
    assert out[1].json == '{"arguments":{"text":"a \\"q\\"\\n\\té"},"call_id":"turn:1","kind":"call","name":"reply","role":"user","turn":1}'
    assert out[3].problems == "text is missing"
    for r in out:
        parsed = json.loads(r.json)
        assert json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json


def test_tool_calls_are_linked_ordered_and_checked(spark):
    rows = [
        (1, 0, "user", "go"),
        (1, 1, "assistant", call({"id": "x", "name": "add", "arguments": {"b": 1.5, "a": 2}, "after": ["y"]}, {"id": "y", "name": "add", "arguments": '{"a": "no", "note": 4}'})),
        (1, 2, "tool", json.dumps({"tool_call_id": "x", "content": "3.5"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "y", "content": "?"})),
        (1, 4, "tool", json.dumps({"tool_call_id": "gone", "content": "!"})),
        (1, 5, "assistant", call({"id": "p", "name": "who", "after": ["q"]}, {"id": "q", "name": "add", "arguments": {"a": 1, "b": 2}, "after": ["p"]})),
        (1, 6, "assistant", "{broken json"),
    ]
    out = run(spark, rows)
    place = {(r.kind, r.call_id): r.position for r in out}
    assert place["call", "y"] < place["result", "y"] and place["call", "y"] < place["call", "x"] < place["result", "x"]
    by = {(r.kind, r.call_id): r for r in out}
    assert by["call", "x"].valid and by["call", "x"].level == 1 and by["result", "x"].level == 2
    assert by["call", "y"].problems == "a is no integer; b is missing; note is no string"
    assert by["call", "p"].problems == "unknown tool" and not by["result", "gone"].linked
    assert by["call", "x"].json.startswith('{"arguments":{"a":2,"b":1.5},"call_id":"x"')
    assert by["result", "x"].json == '{"call_id":"x","content":"3.5","kind":"result","role":"tool","turn":2}'
    assert [r.position for r in out] == list(range(len(out)))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, None, "user", "c"), (3, 0, None, "d"), (4, 0, "user", "x" * 100_000), (4, 0, "user", "x" * 100_000), (4, 1, "assistant", "y")]
    out = run(spark, rows)
    assert len(out) == len(rows)
    assert not any(r.linked for r in out if r.conv_id is None)
    assert [r.linked for r in out if r.conv_id == 4] == [True] * 3
    assert run(spark, []) == []


def test_native_plan(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a", "", "")], SCHEMA)
    plan = chat.format_chats(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
