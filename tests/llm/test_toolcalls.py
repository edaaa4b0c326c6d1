import json

from wardgrid.llm import queries, toolcalls

SCHEMAS = {"add": {"properties": {"a": {"type": "number"}, "b": {"type": "integer"}, "mode": {"type": "string", "enum": ["x", "y"]}}, "required": ["a"], "additionalProperties": False}}


def call(call_id, arguments, *needs, name="add"):
    return {"id": call_id, "name": name, "arguments": arguments, "depends_on": list(needs)}


def test_linking_order_and_arguments(spark):
    stated = [
        call("c1", '{"b": 2.0, "a": 1.5}'),
        call("c2", '{"a": "x"}', "c1"),
        call("c3", "[1]", "c1", "c2"),
        call("c4", "{broken", "c4"),
        call("c5", "", "c6"),
        call("c6", '{"a": 1, "z": 0}', "c5"),
        call("c7", '{"a": true}', "c6"),
        call("c8", '{"mode": "z", "a": NaN}', "nowhere"),
        call("c9", '{"mode": "z", "a": 1}', "nowhere", name="add"),
        call(None, "{}"),
        call("c10", "{}", name="other"),
    ]
    messages = [(1, 0, "assistant", json.dumps({"tool_calls": stated})), (1, 1, "assistant", json.dumps({"tool_calls": [call("c1", '{"a": 9}')]}))]
    messages += [(1, 5 + k, "tool", json.dumps({"tool_call_id": c})) for k, c in enumerate(["c1", "c2", "c1", "lost"])]
    messages += [(2, 0, "tool", json.dumps({"tool_call_id": "c1"})), (2, 3, "assistant", json.dumps({"tool_calls": [call("c1", '{"a": 1}')]}))]
    messages += [(None, 0, "assistant", "{}"), (3, 0, "user", None), (3, None, "assistant", "no json"), (3, 1, "assistant", "")]
    calls, results = toolcalls.calls_of(spark.createDataFrame(messages, "conv_id long, turn long, role string, text string"))
    found = {(r.conv_id, r.call_id): r for r in toolcalls.linked(calls, results, SCHEMAS).collect()}
    assert len(found) == 11
    one = {c: found[1, c] for c in (f"c{k}" for k in range(1, 11))}
    assert (one["c1"].arguments, one["c1"].error, one["c1"].status, one["c1"].result_turn, one["c1"].level) == ('{"a":1.5,"b":2}', None, "linked", 5, 0)
    assert (one["c2"].error, one["c2"].level, one["c2"].status) == ("a is no number", 1, "linked")
    assert (one["c3"].arguments, one["c3"].error, one["c3"].level, one["c3"].status) == (None, "no object", 2, "pending")
    assert [one[c].status for c in ("c4", "c5", "c6", "c7")] == ["cycle"] * 4 and one["c5"].level is None
    assert [one[c].error for c in ("c4", "c5", "c6", "c7")] == ["no JSON", "missing a", "unexpected z", "a is no number"]
    assert (one["c8"].error, one["c9"].error, one["c10"].error) == ("no JSON", "mode is not allowed", "unknown tool")
    assert found[2, "c1"].status == "early"
    assert [tuple(r) for r in toolcalls.orphans(calls, results).collect()] == [(1, 1)]


def test_query_on_odd_rows(spark, tables):
    rows = [(1, k, "user", "a b") for k in range(40)] + [(2, 0, "user", None), (2, 0, "user", None), (None, 1, "user", "x"), (2, None, "user", "x"), (3, 4, "robot", 'é "q"\n')]
    found = {(r.conv_id, r.turn): r for r in queries.op2_tool_calls(spark, tables(conversations=rows)).collect()}
    assert len(found) == 42
    assert all(found[1, k].level == k.bit_length() and found[1, k].status == ("linked" if k < 39 else "pending") for k in range(40))
    assert (found[2, 0].arguments, found[2, 0].error) == ('{"turn":0}', "missing text")
    assert found[3, 4].arguments == '{"text":"é \\"q\\"\\n","turn":4,"words":2}' and found[3, 4].error == "unknown tool"
    assert queries.op2_tool_calls(spark, tables()).count() == 0


def test_canonical_json():
    assert toolcalls.canonical({"b": [1.0, 2.5, None], "a": {"z": True, "é": "\u0001"}}) == '{"a":{"z":true,"é":"\\u0001"},"b":[1,2.5,null]}'


def test_calls_without_identifier_are_rows(spark, tables):
    stated = [call(None, '{"text": "x", "turn": 1}', name="user"), call(None, '{"turn": 1}', "0", name="user"), call(None, "{}", name="other"), call("k", '{"text": "x", "turn": 2}', name="user")]
    text = json.dumps({"tool_calls": stated})
    rows = [(1, 0, "user", "a"), (1, 3, "assistant", text), (2, None, "assistant", text), (None, 4, "assistant", text), (2, None, "user", "b"), (None, None, "user", "c")]
    found = queries.op2_tool_calls(spark, tables(conversations=rows)).collect()
    lost = sorted((r.conv_id, r.turn is None, r.tool, r.arguments, r.error or "", r.level, r.status) for r in found if r.call_id is None)
    for conv, no_turn in ((1, False), (2, True)):
        mine = [r[2:] for r in lost if r[:2] == (conv, no_turn)]
        assert sorted(mine, key=str) == sorted(
            [("other", "{}", "unknown tool", 0, "pending"), ("user", '{"text":"x","turn":1}', "", 0, "pending"), ("user", '{"turn":1}', "missing text", None, "pending")], key=str
        )
    assert len(lost) == 6
    # messages without conversation or turn are no calls themselves; of the stated ones, those with a conversation stay
    assert sorted((r.conv_id, r.call_id) for r in found if r.call_id is not None) == [(1, "0"), (1, "3"), (1, "k"), (2, "k")]


def test_arguments_that_break_parsers(spark):
    stated = [
        call("s", r'{"a": 1, "mode": "\ud800"}'),
        call("k", r'{"\udfff": 1}'),
        call("p", r'{"a": 1, "mode": "\ud83d\ude00"}'),
        call("d", '{"a": ' + "[" * 3000 + "]" * 3000 + "}"),
        call("e", '{"a": ' + '{"x":' * 100_000 + "1" + "}" * 100_000 + "}"),
        call("n", '{"a": 1e-7, "b": 1E400}'),
        call("i", '{"a": ' + "9" * 5000 + "}"),
        call("f", '{"a": 0.0000001}'),
        call("g", '{"a": 1e300}'),
    ]
    messages = spark.createDataFrame([(1, 0, "assistant", json.dumps({"tool_calls": stated}))], "conv_id long, turn long, role string, text string")
    found = {r.call_id: (r.arguments, r.error) for r in toolcalls.linked(*toolcalls.calls_of(messages), SCHEMAS).collect()}
    assert all(found[x] == (None, "no JSON") for x in "skdeni")
    assert found["p"] == ('{"a":1,"mode":"\U0001f600"}', "mode is not allowed")
    assert found["f"] == ('{"a":1e-7}', None) and found["g"] == ('{"a":1e300}', None)


def test_nested_schemas():
    schema = {
        "type": "object",
        "required": ["at"],
        "properties": {
            "at": {"type": "object", "required": ["x"], "properties": {"x": {"type": ["number", "null"]}}, "additionalProperties": False},
            "tags": {"type": "array", "items": {"type": "string", "enum": ["p", "q"]}},
            "any": {},
            "flag": {"enum": [True, None, 1.5]},
            "odd": {"type": "date"},
            "more": {"additionalProperties": {"type": "integer"}},
        },
    }
    tried = {
        '{"at": {"x": null}}': None,
        '{"at": {"x": 1}, "any": [[{}]]}': None,
        '{"at": {"x": "1"}}': "at.x is no number or null",
        '{"at": {}}': "missing at.x",
        '{"at": {"x": 1, "y": 2}}': "unexpected at.y",
        '{"at": 3}': "at is no object",
        '{"at": {"x": 1}, "tags": ["p", "q"]}': None,
        '{"at": {"x": 1}, "tags": ["p", 3]}': "tags[1] is no string",
        '{"at": {"x": 1}, "tags": ["p", "r"]}': "tags[1] is not allowed",
        '{"at": {"x": 1}, "flag": 1}': "flag is not allowed",
        '{"at": {"x": 1}, "flag": true}': None,
        '{"at": {"x": 1}, "flag": 1.5}': None,
        '{"at": {"x": 1}, "odd": "2020-01-01"}': "odd is no date",
        '{"at": {"x": 1}, "more": {"k": 1.0}}': None,
        '{"at": {"x": 1}, "more": {"k": 1.5}}': "more.k is no integer",
        "{}": "missing at",
    }
    assert {text: toolcalls.checked(text, schema)[1] for text in tried} == tried
    assert toolcalls.checked('{"at": {"x": 1}}', {"properties": {"at": {"properties": {"x": {"type": "string"}}}}})[1] == "at.x is no string"
