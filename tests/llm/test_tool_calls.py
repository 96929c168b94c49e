"""Tool-call linking: DuckDB parity, order over general graphs, schemas, odd rows."""

import json
import random

from tonality.llm import tool_calls as T

from .duck import same_as_duckdb

CALL = "conv_id string, call_id string, position int, tool string, arguments string, depends_on array<string>, n int, it string"
RESULT = "content string, conv_id string, call_id string, position int, status string"


def schemas(spark):
    return spark.createDataFrame(T.TOOLS, "tool string, param string, type string, required boolean")


def link(spark, calls, results):
    c = spark.createDataFrame([(*x, 1, "q") for x in calls], CALL)
    r = spark.createDataFrame([(*x, "q") for x in results], RESULT)
    return T.link_tool_calls(c, r, schemas(spark)).collect()


def call(cid, pos, deps=(), conv="a", tool="rewrite", args='{"text":"x"}'):
    return (conv, cid, pos, tool, args, list(deps))


def test_query_equals_duckdb(spark, sf):
    assert same_as_duckdb(T.op4_tool_calls(spark, sf), T.SQL, sf)


def test_query_is_native(spark, sf):
    plan = T.op4_tool_calls(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_depth_of_random_graphs(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for conv in "ab":
        deps = {}
        for k in range(40):
            kind = rnd.random()
            deps[k] = [] if kind < 0.15 or not k else [k - 1] if kind < 0.75 else rnd.sample(range(k), min(k, 3))
        for k, d in deps.items():
            want[conv, f"n{k}"] = 1 + max(want[conv, f"n{p}"] for p in d) if d else 0
            rows.append(call(f"n{k}", k, [f"n{p}" for p in d], conv))
    rows += [call(f"l{k}", 100 + k, [f"l{k - 1}"] if k else [], "c") for k in range(37)]
    want |= {("c", f"l{k}"): k for k in range(37)}
    rows += [call("x", 1, ["y"], "d"), call("y", 2, ["x"], "d"), call("z", 3, ["y"], "d"),
             call("w", 4, ["z", "v"], "d"), call("v", 5, [], "d"), call("s", 6, ["s"], "d")]
    want |= {("d", k): None for k in "xyzws"} | {("d", "v"): 0}
    rnd.shuffle(rows)
    got = link(spark, rows, [])
    assert {(r.conv_id, r.call_id): r.depth for r in got} == want
    assert {r.call_id for r in got if r.status == "cyclic"} == set("xyzws")
    seen = {}
    for k, r in enumerate(got):
        seen[r.conv_id, r.call_id] = k
    for conv, cid, _, _, _, deps in rows:
        if want[conv, cid] is not None:
            assert all(seen[conv, p] < seen[conv, cid] for p in deps)


def test_schemas_and_canonical_json(spark):
    cases = {
        "ok": ("lookup", ' { "text":"a", "limit": 3,\n "strict":true }', []),
        "type": ("lookup", '{"text":1,"limit":"3"}', ["type:limit", "type:text"]),
        "missing": ("translate", "{}", ["missing:strict", "missing:text"]),
        "extra": ("rewrite", '{"zz":[1,{"b":1,"a":2}],"text":"t","limit":1.5,"aa":null}', ["unexpected:aa", "unexpected:zz"]),
        "broken": ("rewrite", '{"text":', ["malformed_arguments"]),
        "list": ("rewrite", "[1]", ["malformed_arguments"]),
        "null": ("rewrite", None, ["malformed_arguments"]),
        "tool": ("nope", "{}", ["unknown_tool"]),
        "notool": (None, "{}", ["unknown_tool"]),
    }
    got = link(spark, [call(k, 0, tool=t, args=a) for k, (t, a, _) in cases.items()], [('r "q"\n', "a", "ok", 5)])
    assert {r.call_id: r.errors for r in got} == {k: v[2] for k, v in cases.items()}
    for r in got:
        rec = json.loads(r.record)
        assert list(rec) == ["arguments", "call_id", "depends_on", "result", "status", "tool"]
        assert rec["tool"] == cases[r.call_id][0]
        if r.call_id == "extra":
            assert r.record.startswith('{"arguments":{"aa":null,"limit":1.5,"text":"t","zz":[1,{"a":2,"b":1}]},')
        if r.call_id == "ok":
            assert rec["result"] == 'r "q"\n' and r.status == "linked"


def test_repeated_missing_and_null(spark):
    calls = [call("a", 5), call("a", 5), call("a", 3), call("a", 9), call("b", 4, ["a", "nope", None]),
             call(None, 1), call("q", 1, conv=None), call("late", 7), ("a", "e", None, None, None, None)]
    results = [("r1", "a", "a", 6), ("r2", "a", "a", 8), ("r", "a", "late", 2), (None, "a", "b", 9),
               ("orphan", "a", "none", 1), ("x", None, None, 1)]
    got = link(spark, calls, results)
    assert len(got) == len(calls)
    by = sorted((r.call_id or "", r.position or -1, r.status, r.n_results) for r in got)
    assert by == sorted([("a", 3, "linked", 2), ("a", 5, "duplicate", 0), ("a", 5, "duplicate", 0),
                         ("a", 9, "duplicate", 0), ("b", 4, "linked", 1), ("", 1, "invalid_id", 0),
                         ("q", 1, "invalid_id", 0), ("late", 7, "result_before_call", 1), ("e", -1, "no_result", 0)])
    b = next(r for r in got if r.call_id == "b")
    assert b.errors == ["dangling:nope"] and b.depth == 1 and json.loads(b.record)["result"] is None
    assert link(spark, [], []) == []
