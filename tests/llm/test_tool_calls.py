"""Tool-call linking against a plain Python reading of its rules."""

import json
import random
from collections import Counter

import pytest

from sideline.llm import tool_calls

CALLS = "conv string, id string, name string, arguments string, needs array<string>, level int, value string"
SCHEMAS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False), ("list", "items", "array", True), ("list", "at", "object", False), ("now", None, None, None), ("flag", "on", "boolean", True), ("flag", "nil", "null", False)]


def _kind(v):
    if isinstance(v, bool):
        return {"boolean"}
    if v is None:
        return {"null"}
    return {int: {"integer", "number"}, float: {"number"}, str: {"string"}, list: {"array"}, dict: {"object"}}[type(v)]


def _problems(name, arguments, cyclic):
    out = []
    try:
        args = json.loads(arguments)
        assert isinstance(args, dict)
    except Exception:
        args = None
        out.append("malformed arguments")
    fields = [s for s in SCHEMAS if s[0] == name]
    if not fields:
        out.append("unknown tool")
    elif args is not None:
        known = {f: (t, r) for _, f, t, r in fields if f}
        out += [f"missing: {f}" for f, (t, r) in known.items() if r and f not in args]
        out += [f"wrong type: {f}" for f, (t, r) in known.items() if f in args and t not in _kind(args[f])]
        out += [f"not in schema: {f}" for f in args if f not in known]
    return sorted(out + ["cycle"] * cyclic), args


def _levels(needs):
    level = {}
    while True:
        ready = [i for i, n in needs.items() if i not in level and all(x in level for x in n)]
        if not ready:
            return level
        level |= {i: 1 + max((level[x] for x in needs[i]), default=-1) for i in ready}


def _arguments(rng):
    return rng.choice([
        '{"b": 2.5, "a": 1}', '{"a":1,"b":1}', '{"a":"1","b":2,"note":null}', '{"items":[1,{"z":1,"y":[]}],"at":{"q":1,"p":{"d":1,"c":2}}}', "{}", "[1]", "nonsense", "{", None,
        '{"on": true, "nil": null}', '{"on":1}', '{"é":"\\u00e9 \\n"}', '"text"'])


@pytest.fixture(scope="module")
def given(spark):
    rng = random.Random(12)
    calls = []
    for i in range(300):
        conv = "hot" if rng.random() < 0.4 else f"c{rng.randrange(20)}"
        needs = [f"k{rng.randrange(i)}" for _ in range(rng.randrange(3))] if i else None
        calls.append((conv, f"k{i}", rng.choice(["add", "list", "now", "flag", "other", None]), _arguments(rng), needs))
    calls += [("loop", "x1", "now", "{}", ["x2"]), ("loop", "x2", "now", "{}", ["x1"]), ("loop", "x3", "now", "{}", ["x2", "none"]), ("own", "x4", "now", "{}", ["x4"]), (None, "x5", "now", "{}", ["gone"])]
    calls += [("no", None, "now", "{}", None), ("no", None, "now", "{}", ["k1"]), calls[5], calls[5]]
    results = [(f"k{i}", f"r{i}") for i in range(0, 300, 2)] + [("k4", "a"), ("lost", "z"), ("lost", None), (None, "q")]
    frame = spark.createDataFrame([(*c, 7, "v") for c in calls], CALLS)
    return calls, results, frame, spark.createDataFrame([(*r, True) for r in results], "id string, content string, called boolean")


def test_link(spark, given):
    calls, results, frame, answers = given
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    got = tool_calls.link(frame, answers, schemas).collect()
    unique = {c[1]: c for c in calls if c[1] is not None}
    content = {}
    for i, c in results:
        if i is not None:
            content.setdefault(i, []).append(c)
    needs = {i: [n for n in (c[4] or []) if n in unique] for i, c in unique.items()}
    levels = _levels(needs)
    assert Counter(r.id for r in got) == Counter([*unique, None, None, None, "lost"])
    times = Counter(c[1] for c in calls)
    for r in got:
        record = json.loads(r.json)
        assert list(record) == sorted(record) and r.json == json.dumps(record, separators=(",", ":"), ensure_ascii=False).replace("\x7f", "\x7f")
        if r.status == "no_id":
            assert r.id is None and r.conv == "no"
        elif r.status == "no_call":
            assert (r.id, r.repeats, record["content"]) in (("lost", 1, "z"), (None, 0, "q")) and r.problems == []
        else:
            c = unique[r.id]
            problems, args = _problems(c[2], c[3] or "", r.id not in levels)
            assert r.problems == problems and r.level == levels.get(r.id) and record["arguments"] == args
            assert r.status == ("linked" if r.id in content else "no_result")
            assert r.repeats == times[r.id] - 1 + len(content.get(r.id, [0])) - 1
            assert record["content"] == min((x for x in content.get(r.id, []) if x is not None), default=None)
            assert record["arguments"] is None or json.dumps(record["arguments"]) == json.dumps(args, sort_keys=True)
    for conv in {r.conv for r in got}:
        mine = sorted((r for r in got if r.conv == conv), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))
        order = [(r.level is None, r.level or 0, r.id is None, r.id or "") for r in mine]
        assert order == sorted(order)


def test_link_empty(spark, given):
    _, _, frame, answers = given
    schemas = spark.createDataFrame([], "name string, field string, type string, required boolean")
    assert tool_calls.link(frame.limit(0), answers.limit(0), schemas).count() == 0
    assert {r.status for r in tool_calls.link(frame.limit(0), answers, schemas).collect()} == {"no_call"}
    assert {tuple(r.problems) for r in tool_calls.link(frame.filter("id = 'x5'"), answers.limit(0), schemas).collect()} == {("unknown tool",)}


def test_from_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", None), (1, 4, "user", "x" * 13), (2, 0, "assistant", "alone"), (None, 0, "user", "q"), (3, 0, None, None)]
    calls, results = tool_calls.from_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.id: r.needs for r in calls.collect()} == {"1-0": None, "1-2": ["1-0"], "1-4": ["1-2"], None: None}
    assert {r.id for r in results.collect()} == {"1-0", "2--1"}


def test_turns_without_a_conversation_stay_apart(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "b"), (None, 0, "user", "b"), (4, None, "user", "c"), (None, 1, "assistant", "d"), (4, None, "assistant", "e"), (5, 0, "user", "f"), (5, 1, "assistant", "g")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    got = tool_calls.link(*tool_calls.from_conversations(turns), schemas).collect()
    assert Counter(r.status for r in got) == {"no_id": 4, "no_call": 2, "linked": 1}
    assert all(r.repeats == 0 for r in got)
    for conv in (None, "4", "5"):
        mine = [r.position for r in got if r.conv == conv]
        assert sorted(mine) == list(range(1, len(mine) + 1))
