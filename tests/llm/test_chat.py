"""Chat formatting against plain Python, with cycles, missing parts, bad arguments and repeated ids."""

import json
import random
import time
from collections import defaultdict

import pytest
from corpus_rows import read
from hypothesis import given, settings, strategies as st

from playlake.llm.chat import ANSWER_SCHEMA, calls_of_conversations, canonical, format_tool_calls, levels_of, numbered, schema_errors, topological_levels

CALLS = "conv_id long, call_id string, name string, arguments string, depends_on array<string>, position long, level string, step string"
RESULTS = "conv_id long, call_id string, content string, position long, valid string"
SCHEMAS = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}}, "additionalProperties": False}}


def run(spark, calls, results, schemas=None):
    c = spark.createDataFrame([(*x, None, "clash") for x in calls], CALLS)
    r = spark.createDataFrame([(*x, None) for x in results], RESULTS)
    rows = format_tool_calls(c, r, SCHEMAS if schemas is None else schemas).collect()
    return sorted(rows, key=lambda r: (str(r.conv_id), r.step))


def test_linked_ordered_validated(spark):
    calls = [
        (1, "c", "add", '{"a": 3}', ["b"], 0),
        (1, "b", "add", '{ "a":2 }', ["a"], 1),
        (1, "a", "add", '{"a": "x", "z": null}', [], 2),
        (1, "d", "add", "{not json", None, 3),
        (1, "e", "none", "[]", ["gone", "gone"], 4),
        (1, "f", "add", '{"a":1}', ["g"], 5),
        (1, "g", "add", '{"a":1}', ["f"], 6),
        (1, "s", "add", '{"a":1}', ["s"], 7),
        (2, "c", "add", '{"a":1}', [], 0),
        (2, "c", "add", '{"a":9}', [], 1),  # the same id again
        (None, "c", "add", '{"a":1}', [], 0),
        (3, None, "add", '{"a":1}', [], 0),
    ]
    results = [(1, x, f"r{x}", 5) for x in "abcdfgs"] + [(1, "c", "later", 9), (1, "nobody", "lost", 1), (None, "c", None, 1), (4, None, "x", 1)]
    rows = run(spark, calls, results)
    one = [r for r in rows if r.conv_id == 1]
    assert [r.call_id for r in one] == ["a", "d", "e", "b", "c", "f", "g", "s"]
    assert [r.level for r in one] == [0, 0, 0, 1, 2, None, None, None]
    by = {r.call_id: r for r in one}
    assert by["a"].errors == ["$.z: unknown", "$.a: not integer"]
    assert by["d"].errors == ["$: not JSON"]
    assert by["e"].errors == ["no schema of that name", "depends on gone, which is missing", "no result"]
    assert by["f"].errors == by["s"].errors == ["depends on itself"]
    assert by["c"].valid and by["c"].n_results == 2
    assert by["c"].message == '{"arguments":{"a":3},"depends_on":["b"],"id":"c","name":"add","result":"rc","type":"tool_call"}'
    (two,) = [r for r in rows if r.conv_id == 2]
    assert json.loads(two.message)["arguments"] == {"a": 1} and two.errors == ["no result"]
    (none,) = [r for r in rows if r.conv_id is None]
    assert none.n_results == 1 and none.valid
    assert len(rows) == 10


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert [r.errors for r in run(spark, [(1, "a", "add", None, None, None)], [])] == [["$: not JSON", "no result"]]


def test_every_conversation(spark):
    turns = read(spark, "sf0.001", "conversations")
    calls, results = calls_of_conversations(turns)
    got = {(r.conv_id, r.call_id): r for r in format_tool_calls(calls, results, {"answer": ANSWER_SCHEMA}).collect()}
    said = {(r.conv_id, r.turn): r for r in turns.collect()}
    want, order = {}, defaultdict(list)
    for (conv, turn), r in said.items():
        if r.role == "user":
            half = turn // 2
            parent = 2 * (half & (half - 1)) + turn % 2
            answer = said.get((conv, turn + 1))
            answer = answer.text if answer and answer.role == "assistant" else None
            body = {
                "arguments": {"prompt": r.text, "turn": turn, "words": len(r.text.split())},
                "depends_on": [f"call-{conv}-{parent}"] if half else [],
                "id": f"call-{conv}-{turn}", "name": "answer", "result": answer, "type": "tool_call",
            }
            want[conv, f"call-{conv}-{turn}"] = body
    assert set(got) == set(want)
    for key, r in got.items():
        assert r.message == json.dumps(want[key], sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        missing = [d for d in want[key]["depends_on"] if (key[0], d) not in want]
        wrong = schema_errors(want[key]["arguments"], ANSWER_SCHEMA) + missing + ([] if want[key]["result"] is not None else ["none"])
        assert r.valid == (not wrong) and len(r.errors) == len(wrong)
        order[key[0]].append((r.step, r.level, r.call_id))
    for conv, rows in order.items():
        rows.sort()
        assert [s for s, _, _ in rows] == list(range(len(rows)))
        place = {c: s for s, _, c in rows}
        assert all(place[d] < place[c] for c in place for d in want[conv, c]["depends_on"] if d in place)


def test_one_conversation_with_most_of_the_rows(spark):
    n = 2000
    calls = [(7, f"c{i}", "add", '{"a":1}', [f"c{i & (i - 1)}"] if i else [], (i * 7919) % n) for i in range(n)]
    rows = run(spark, calls, [])
    assert [r.step for r in rows] == list(range(n))
    place = {r.call_id: r.step for r in rows}
    assert all(place[f"c{i & (i - 1)}"] < place[f"c{i}"] for i in range(1, n))
    assert max(r.level for r in rows) == max(bin(i).count("1") for i in range(n))


def test_levels_of_a_chain_and_a_cycle_behind_it(spark):
    rows = [(1, f"n{i}", [f"n{i - 1}"] if i else []) for i in range(6)] + [(1, "x", ["y", "n5"]), (1, "y", ["x"]), (1, "z", ["y"])]
    rows += [(2, "a", ["a"]), (2, "b", ["b", "c", "gone"]), (2, "c", [])]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>")
    one = {f"n{i}": i for i in range(6)} | {"x": None, "y": None, "z": None}
    for in_task in (100, 5, 1):  # in tasks, the large one in rounds, both in rounds
        found = topological_levels(calls, in_task).collect()
        assert {r.call_id: r.level for r in found if r.conv_id == 1} == one
        assert {r.call_id: r.level for r in found if r.conv_id == 2} == {"a": None, "b": None, "c": 0}


def test_a_long_chain_and_many_conversations_in_one_task(spark):
    rows = [(1, f"n{i}", [f"n{i - 1}"] if i else None) for i in range(3000)]
    rows += [(c, f"k{i}", [f"k{i + 1}"] if i < 4 else []) for c in range(2, 400) for i in range(5)]
    found = topological_levels(spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>").repartition(3))
    levels = {(r.conv_id, r.call_id): r.level for r in found.collect()}
    assert len(levels) == len(rows)
    assert all(levels[1, f"n{i}"] == i for i in range(3000))
    assert all(levels[c, f"k{i}"] == 4 - i for c in range(2, 400) for i in range(5))


def test_numbered_over_several_partitions(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i) for i in range(500)], "g long, v long").repartition(5)
    rows = numbered(df, "g", ["v"]).collect()
    for g in (None, 0, 1, 2):
        mine = sorted((r.step, r.v) for r in rows if r.g == g)
        assert [s for s, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(max_size=3), v, max_size=3),
    max_leaves=8,
)


@settings(max_examples=150, deadline=None)
@given(VALUES)
def test_canonical_json_round_trip(value):
    text = canonical(value)
    assert json.loads(text) == value and canonical(json.loads(text)) == text


def test_canonical_numbers_and_keys():
    assert canonical({"b": 1.0, "a": [1e-7, 1.5, 10**20, 1e21]}) == '{"a":[1e-7,1.5,100000000000000000000,1e+21],"b":1}'
    assert canonical({"דּ": 1, "\U0001f600": 2}) == '{"\U0001f600":2,"דּ":1}'
    with pytest.raises(ValueError):
        canonical(float("nan"))


def test_schema_rules():
    schema = {"type": ["object", "null"], "properties": {"l": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "number", "minimum": 0, "maximum": 9}}, "s": {"enum": ["x"], "type": "string", "minLength": 1}}}
    assert schema_errors(None, schema) == [] and schema_errors({"l": [1, 2.5], "s": "x"}, schema) == []
    assert schema_errors({"l": [], "s": ""}, schema) == ["$.l: shorter than 1", "$.s: not among the values allowed", "$.s: shorter than 1"]
    assert schema_errors({"l": [-1, 10, True]}, schema) == ["$.l: longer than 2", "$.l[0]: below 0", "$.l[1]: above 9", "$.l[2]: not number"]
    assert schema_errors(3, schema) == ["$: not object or null"]


def test_arguments_no_json_text_can_keep(spark):
    """Numbers beyond a double, lone surrogates and deep nesting give errors, not a crash."""
    deep = "[" * 2000 + "]" * 2000
    calls = [
        (1, "a", "add", '{"a":1e999}', [], 0),
        (1, "b", "add", r'{"a":1,"\ud800":"x\udfff"}', [], 1),
        (1, "c", "add", deep, [], 2),
        (1, "d", "add", "[" * 200 + "]" * 200, [], 3),
        (1, "e", "add", '{"a":' + "9" * 5000 + "}", [], 4),
        (1, "f", "add", '{"a":NaN}', [], 5),
        (1, "g", "add", r'{"a":1,"z":"\ud83d\ude00"}', [], 6),
    ]
    rows = {r.call_id: r for r in run(spark, calls, [(1, c[1], "r", 0) for c in calls])}
    assert rows["a"].errors == ["$: number out of range"] and json.loads(rows["a"].message)["arguments"] == '{"a":1e999}'
    assert rows["b"].errors == [r"$.\ud800: unknown"]
    assert json.loads(rows["b"].message)["arguments"] == {"a": 1, "\ud800": "x\udfff"}
    assert rows["c"].errors == ["$: nested too deep"] and json.loads(rows["c"].message)["arguments"] == deep
    assert rows["d"].errors == ["$: not object"]
    assert rows["e"].errors == ["$: not JSON"] and rows["f"].errors == ["$: not JSON"]
    assert json.loads(rows["g"].message)["arguments"]["z"] == "\U0001f600"


def test_enum_tells_booleans_from_numbers():
    for value, allowed, fits in ((True, [1], False), (1, [True], False), (1.0, [1], True), (0, [False], False), ([1], [[True]], False),
                                 ({"a": 1}, [{"a": 1.0}], True), (None, [None], True), ("1", [1], False)):
        assert (schema_errors(value, {"enum": allowed}) == []) == fits


def test_null_conversations_and_extreme_ids_are_told_apart(spark):
    calls = [(i, "a", "add", '{"a":1}', [], 0) for i in (None, -(1 << 63), (1 << 63) - 1)]
    rows = run(spark, calls, [(-(1 << 63), "a", "mine", 0)])
    assert {r.conv_id: r.n_results for r in rows} == {None: 0, -(1 << 63): 1, (1 << 63) - 1: 0}


def test_levels_of_random_graphs_by_rounds(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for conv in range(12):
        depends = {}
        for i in range(40):
            pool = range(max(0, i - 6), i) if conv % 3 else range(40)  # every third conversation has cycles
            depends[f"c{i}"] = [f"c{j}" for j in rng.sample(pool, min(len(pool), rng.choice((0, 1, 1, 1, 2, 3))))]
        rows += [(conv, c, d) for c, d in depends.items()]
        levels = levels_of(depends)
        want |= {(conv, c, levels.get(c)) for c in depends}
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>")
    assert {tuple(r) for r in topological_levels(calls, in_task=1).collect()} == want


def test_a_chain_of_20000_calls_by_rounds(spark):
    began, size = time.monotonic(), 20_000
    calls = spark.range(size).selectExpr(
        "1L AS conv_id", "concat('c', id) AS call_id", "if(id > 0, array(concat('c', id - 1)), array()) AS depends_on")
    found = topological_levels(calls, in_task=100)
    assert found.where("level = cast(substring(call_id, 2) AS int)").count() == size
    assert time.monotonic() - began < 60
