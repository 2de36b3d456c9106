import json

from millrace.llm.contract import ORACLES, QUERIES
from millrace.llm.tool_calls import Field, levels, link
from tests.oracle import compare

TOOLS = {"add": [Field("a", "integer", least=0), Field("b", "number", False, most=9)], "say": [Field("text", "string", most=3), Field("loud", "boolean", False)]}
CALLS = "call_id string, turn bigint, name string, arguments string, depends_on array<string>"


def run(spark, calls, results):
    out = link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, "call_id string, turn bigint, content string"), TOOLS)
    return {r["call_id"] if r["call_id"] or r["name"] else "lost": r for r in out.collect()}


def test_links_orders_and_serialises(spark):
    calls = [
        ("c", 3, "add", ' {"b": 1.5, "a": 2}', ["a", "b"]),
        ("a", 1, "add", '{"a": 1}', []),
        ("b", 2, "say", '{"text": "hi", "loud": true}', ["a", "gone"]),
        ("x", 1, "say", '{"text": "abcd", "more": 1}', ["y"]),
        ("y", 1, "say", "not json", ["x"]),
        ("z", 1, "say", '{"text": "ok"}', ["y"]),
        ("q", 1, "add", '{"a": "1", "b": 10}', None),
        ("w", 5, "who", "{}", []),
        ("late", 5, "add", '{"a": 1}', []),
        (None, 9, "add", '{"a": 1}', []),
        ("a", 7, "add", '{"a": 5}', []),
    ]
    results = [("a", 2, "A"), ("a", 3, "B"), ("b", 4, 'quo"te\né'), ("late", 5, "L"), ("nobody", 1, "N"), (None, 1, "N")]
    got = run(spark, calls, results)
    assert [got[k]["level"] for k in "abcxyz"] == [0, 1, 2, None, None, None]
    assert {k: r["status"] for k, r in got.items()} == {"a": "ok", "b": "ok", "c": "unanswered", "x": "cyclic", "y": "cyclic", "z": "cyclic", "q": "invalid", "w": "invalid", "late": "out_of_order", "nobody": "orphan_result", None: "unlinked", "lost": "unlinked"}
    assert got["b"]["n_missing"] == 1 and got["a"]["n_calls"] == 2 and got["a"]["n_results"] == 2
    assert got["x"]["problems"] == "more: unknown; text: above 3" and got["q"]["problems"] == "a: not a integer; b: above 9"
    assert got["y"]["problems"] == "arguments: not an object" and got["w"]["problems"] == "unknown tool"
    assert got["c"]["json"] == '{"arguments":{"a":2,"b":1.5},"id":"c","level":2,"name":"add","status":"unanswered"}'
    assert json.loads(got["b"]["json"])["result"] == 'quo"te\né'
    assert json.loads(got["lost"]["json"]) == {"result": "N", "status": "unlinked"}


def test_levels_of_a_dag(spark):
    edges = {i: [j for j in range(i) if (i * 7 + j * 3) % 5 == 0] for i in range(30)}
    want = {}
    for i in range(30):
        want[str(i)] = max((want[str(j)] + 1 for j in edges[i]), default=0)
    df = spark.createDataFrame([(str(i), [str(j) for j in v]) for i, v in edges.items()], "call_id string, depends_on array<string>")
    assert {r["call_id"]: r["level"] for r in levels(df).collect()} == want


def test_empty(spark):
    assert run(spark, [], []) == {}


def test_oracle(spark):
    compare(QUERIES["op7_tool_call_linking"](spark, "/root/testdata/sf0.01"), ORACLES["op7_tool_call_linking"], "/root/testdata/sf0.01")


def test_chains_of_any_length(spark):
    """A chain of 5,000 calls, a tree that hangs on its end, and a cycle with a tail."""
    n = 5000
    calls = [(str(i), [str(i - 1)] if i else []) for i in range(n)] + [(f"t{i}", [str(n - 1)]) for i in range(50)] + [("end", ["t1", "t2", "7"])]
    calls += [("after", ["end"])] + [(f"c{i}", [f"c{(i + 1) % 9}"]) for i in range(9)] + [("tail", ["c0"]), ("both", ["tail", "0"]), ("self", ["self"])]
    got = {r["call_id"]: r["level"] for r in levels(spark.createDataFrame(calls, "call_id string, depends_on array<string>")).collect()}
    assert [got[str(i)] for i in range(n)] == list(range(n))
    assert {got[f"t{i}"] for i in range(50)} == {n} and got["end"] == n + 1 and got["after"] == n + 2
    assert {got[k] for k in ("c0", "c8", "tail", "both", "self")} == {None}


def test_nested_arguments(spark):
    tools = {"go": [Field("to", "object", fields=(Field("x", "integer", least=0), Field("unit", "string", False, values=("km", "mi")))), Field("tags", "array", False, most=2, items="string"), Field("mode", "string", False, values=("a", "b"))]}
    rows = ['{"to": {"x": 1, "unit": "km"}, "tags": ["p"], "mode": "a"}', '{"to": {"x": -1, "unit": "ft", "z": 0}, "tags": ["p", 1, "q"], "mode": "c"}', '{"to": [1], "tags": "p"}', '{"to": {}}', '{"to": null}']
    calls = spark.createDataFrame([(str(i), 1, "go", t, []) for i, t in enumerate(rows)], CALLS)
    got = {r["call_id"]: r["problems"] for r in link(calls, spark.createDataFrame([], "call_id string, turn bigint, content string"), tools).collect()}
    assert got["0"] == "" and got["3"] == "to.x: missing" and got["4"] == "to: not a object"
    assert got["1"] == "mode: not an allowed value; tags: above 2; tags: not all items are string; to.unit: not an allowed value; to.x: below 0; to.z: unknown"
    assert got["2"] == "tags: not a array; to: not a object"


def test_long_texts_null_turns_and_other_columns(spark):
    long = "word " * 400_000
    calls = spark.createDataFrame([("a", None, "say", '{"text": "ok"}', [], 1), ("b", 1, "say", json.dumps({"text": long}), [], 2)], CALLS + ", status int")
    results = spark.createDataFrame([("a", 2, "A", "k"), ("b", 3, long, "k")], "call_id string, turn bigint, content string, json string")
    context = spark.createDataFrame([("a", 0, "system", "S", 1), ("a", 0, "system", "S", 1), ("a", None, "user", None, 1), (None, 1, "user", "U", 1)], "call_id string, turn bigint, role string, content string, level int")
    got = {(r["call_id"], r["name"]): r for r in link(calls, results, TOOLS, context).collect()}
    assert got["a", "say"]["status"] == "out_of_order" and got["b", "say"]["status"] == "invalid"
    assert json.loads(got["b", "say"]["json"])["result"] == long
    assert got["a", "system"]["n_results"] == 2 and got["a", "system"]["json"] == '{"content":"S","id":"a","role":"system","status":"context"}'
    assert got["a", "user"]["json"] == '{"id":"a","role":"user","status":"context"}' and got[None, "user"]["status"] == "unlinked"


def test_every_message_of_a_conversation_is_carried_whole(spark):
    said = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    texts = [json.loads(r["json"]) for r in QUERIES["op7_tool_call_linking"](spark, "/root/testdata/sf0.001").collect()]
    found = [t for d in texts for t in (d.get("content"), d.get("result"), d.get("arguments", {}).get("text")) if t is not None]
    assert sorted(found) == sorted(r["text"] for r in said)
