import json

import duckdb
import pytest

from panelspark.llm import toolcalls
from panelspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
CALL = "conv_id long, call_id string, after string, name string, arguments string, content string"
RESULT = "conv_id long, call_id string, content string, depth int"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(ORACLES["op2_tool_calls"])
    out = QUERIES["op2_tool_calls"](spark, SF)
    names = sorted(out.columns)
    assert sorted(want.columns) == names
    assert sorted(map(tuple, out.select(names).collect()), key=str) == sorted(want.select(", ".join(names)).fetchall(), key=str)


def test_plan_has_no_python(spark, capsys):
    QUERIES["op2_tool_calls"](spark, SF).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Arrow", "Pandas"))


def test_links_orders_checks_and_serialises(spark):
    calls = [
        (1, "a", None, "ask", '{"words": 3, "query": "x \\"é\\""}', "clash"),
        (1, "b", "a", "ask", '{"query": "", "words": "3", "more": {"b": 1, "a": [1, null]}}', None),
        (1, "b", "a", "ask", '{"query": "z", "words": 1}', None),
        (1, "c", "b", "ask", "not json", None),
        (1, "d", "gone", "ask", None, None),
        (2, "e", "f", "other", "{}", None),
        (2, "f", "e", "ask", '{"query": null, "words": 2.5}', None),
        (2, "g", "f", "ask", "[1]", None),
        (None, "h", "c", "configure", '{"prompt": "p"}', None),
        (2, None, None, "configure", '{"prompt": "p"}', None),
    ]
    results = [(1, "a", "one", 9), (1, "a", "One", 9), (1, "c", None, 9), (2, "a", "wrong", 9), (None, "h", "null conversation", 9), (2, None, "no id", 9)]
    out = toolcalls.linked(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT))
    got = {r.call_id: r for r in out.collect()}
    got = {r.call_id: r for r in out.collect() if r.copies}
    (orphan,) = [r for r in out.collect() if not r.copies]
    assert (orphan.conv_id, orphan.call_id, orphan.answers, orphan.linked, orphan.faults) == (2, "a", 1, False, "call: missing")
    assert json.loads(orphan.json) == {"arguments": {"arguments": None}, "depth": 0, "id": "a", "name": None, "result": "wrong"}
    assert len(got) == 9 and got["a"].answers == 2 and got["b"].answers == 0
    assert {k: (r.depth, r.rooted) for k, r in got.items()} == {
        "a": (0, True), "b": (1, True), "c": (2, True), "d": (0, False), "e": (None, False), "f": (None, False),
        "g": (None, False), "h": (3, True), None: (None, False),
    }
    assert {k for k, r in got.items() if r.linked} == {"a", "c", "h"}
    assert {k: r.faults for k, r in got.items()} == {
        "a": "", "b": "query: min_length; words: type; more: unknown", "c": "arguments: not JSON", "d": "arguments: not JSON",
        "e": "name: unknown", "f": "query: missing; words: type", "g": "arguments: not an object", "h": "", None: "",
    }
    assert got["b"].copies == 2 and got["a"].valid and not got["b"].valid
    assert got["a"].json == '{"arguments":{"query":"x \\"é\\"","words":3},"depth":0,"id":"a","name":"ask","result":"One"}'
    assert '"more":{"a":[1,null],"b":1}' in got["b"].json
    for r in got.values():
        assert list(json.loads(r.json)) == sorted(json.loads(r.json))


def test_long_chains_take_few_rounds(spark):
    nodes = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(300)]
    out = toolcalls.depths(spark.createDataFrame(nodes, "node string, after string"))
    assert {r.node: r.depth for r in out.collect()} == {f"n{i}": i for i in range(300)}


def longest(edges):
    """(depth, rooted) of each node by recursion; null depth on a way into a cycle."""
    before = {}
    for node, after in edges:
        before.setdefault(node, set()).update([after] if after is not None else [])

    def visit(node, path):
        if node in path:
            return None, False
        if not before[node]:
            return 0, True
        ways = [visit(b, path | {node}) if b in before else (-1, False) for b in before[node]]
        if any(d is None for d, _ in ways):
            return None, False
        return max(d for d, _ in ways) + 1, all(r for _, r in ways)

    return {node: visit(node, frozenset()) for node in before}


@pytest.mark.parametrize("seed", range(4))
def test_depths_of_graphs(spark, seed):
    import random

    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(24)]
    edges = [(n, None if rng.random() < 0.3 or not i else nodes[rng.randrange(i)]) for i, n in enumerate(nodes)]
    edges += [(nodes[i], nodes[rng.randrange(i)]) for i in rng.sample(range(1, 24), 6)]
    edges += [("x", "gone"), ("y", "x"), ("y", "n3"), (None, "n1")] + [("n4", "n9")] * (seed % 2) + [("c1", "c2"), ("c2", "c1"), ("d", "c1"), ("d", "n2")]
    out = toolcalls.depths(spark.createDataFrame(edges, "node string, after string"))
    got = {r.node: (r.depth, r.rooted) for r in out.collect()}
    assert got == longest([e for e in edges if e[0] is not None])


def test_a_call_that_needs_two_results_comes_after_both(spark):
    calls = [(1, "a", None), (1, "b", "a"), (1, "c", "b"), (1, "d", "a"), (1, "d", "c"), (1, "e", "d")]
    rows = [(c, k, after, "ask", '{"query": "q", "words": 1}', None) for c, k, after in calls]
    out = toolcalls.linked(spark.createDataFrame(rows, CALL), spark.createDataFrame([], RESULT))
    assert {r.call_id: (r.depth, r.copies) for r in out.collect()} == {"a": (0, 1), "b": (1, 1), "c": (2, 1), "d": (3, 1), "e": (4, 1)}


@pytest.mark.parametrize("turns", [[], [(None, 0, "user", "a"), (1, None, "user", "a"), (1, 0, None, "a"), (1, 1, "user", None), (1, 1, "user", None)]])
def test_odd_turns(spark, turns):
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    calls, results, nodes = toolcalls.from_conversations(table)
    out = toolcalls.linked(calls, results, nodes=nodes).collect()
    assert len(out) == (3 if turns else 0)
    if turns:
        assert {r.faults for r in out if r.call_id == "1:1"} == {"query: missing; words: missing"}
