import json

import numpy as np

from sparkqc.llm import chat_format as cf

CALLS = "conv long, id string, after string, name string, arguments map<string,string>"
RESULTS = "conv long, id string, content string"
TOOLS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "flag": {"on": ("boolean", True)}}


def link(spark, calls, results):
    rows = cf.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()
    return {(r.conv, r.id, r.kind): r for r in rows}


def test_states_levels_and_json(spark):
    got = link(spark, [(1, "a", None, "add", {"b": "2.5", "a": "1", "note": 'say "hi"\n'}), (1, "b", "a", "flag", {"on": "true"}), (1, "c", "b", "flag", {"on": "yes", "z": "1"}),
                       (1, "d", "nowhere", "none", {}), (2, "a", None, "add", {"a": "x", "b": None})],
               [(1, "a", "3.5"), (1, "b", None), (2, "zzz", "lost")])
    assert {k: (r.state, r.level, r.place) for k, r in got.items()} == {
        (1, "a", "call"): ("linked", 0, 0), (1, "a", "result"): ("linked", 0, 1), (1, "b", "call"): ("linked", 1, 2), (1, "b", "result"): ("linked", 1, 3),
        (1, "c", "call"): ("unanswered", 2, 4), (1, "d", "call"): ("unanswered", 0, 0), (2, "a", "call"): ("unanswered", 0, 0), (2, "zzz", "result"): ("orphan", None, None)}
    assert got[1, "a", "call"].message == '{"arguments":{"a":1,"b":2.5,"note":"say \\"hi\\"\\n"},"id":"a","name":"add"}'
    assert got[1, "b", "result"].message == '{"content":null,"tool_call_id":"b"}'
    assert got[1, "c", "call"].errors == ["type:on", "unknown:z"] and got[1, "d", "call"].errors == ["tool"]
    assert got[2, "a", "call"].errors == ["missing:b", "type:a"]
    for r in got.values():
        parsed = json.loads(r.message)
        assert r.message == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_long_chain_shuffled_and_cycles(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n).tolist()
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None, "flag", {"on": "true"}) for i in order]
    calls += [(2, "x", "y", "flag", {}), (2, "y", "x", "flag", {}), (2, "z", "x", "flag", {}), (2, "self", "self", "flag", {})]
    got = link(spark, calls, [(2, "x", "r")])
    assert all(got[1, f"c{i}", "call"].level == i for i in range(n))
    assert {k[1]: (r.state, r.level) for k, r in got.items() if k[0] == 2 and k[2] == "call"} == {k: ("cycle", None) for k in ("x", "y", "z", "self")}
    assert got[2, "x", "result"].state == "cycle"


def test_ties_nulls_and_empty_tables(spark):
    got = link(spark, [(1, "a", None, "flag", {"on": "true"}), (1, "a", None, "flag", {"on": "true"}), (1, "a", None, "add", None), (None, "a", None, "flag", {}), (3, None, None, None, {})],
               [(1, "a", "z"), (1, "a", "b"), (None, "a", "n")])
    assert got[1, "a", "call"].n_rows == 3 and '"name":"add"' in got[1, "a", "call"].message
    assert got[1, "a", "result"].n_rows == 2 and json.loads(got[1, "a", "result"].message)["content"] == "b"
    assert got[None, "a", "call"].state == "unanswered" and got[None, "a", "result"].state == "orphan" and got[3, None, "call"].errors == ["tool"]
    assert link(spark, [], []) == {}


def test_conversations(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a" * 50000), (1, 3, "user", None), (2, 5, "assistant", "alone"), (2, 6, None, "no role"), (None, 0, "user", "q")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS id", "2 AS name")
    calls, results = cf.conversation_calls(frame)
    got = {(r.conv, r.id, r.kind): (r.state, r.level) for r in cf.link(calls, results, cf.CONVERSATION_TOOLS).collect()}
    assert got == {(1, "call_1_0", "call"): ("unanswered", 0), (1, "call_1_1", "call"): ("linked", 1), (1, "call_1_1", "result"): ("linked", 1), (1, "call_1_3", "call"): ("unanswered", 2),
                   (2, "call_2_4", "result"): ("orphan", None), (2, "call_2_5", "result"): ("orphan", None), (None, None, "call"): ("unanswered", None)}


def test_no_message_is_lost_to_a_null_or_repeated_key(spark):
    rows = [(None, t, "user", f"q{t}") for t in range(5)] + [(7, None, "user", x) for x in "ab"] + [(None, 1, "assistant", "r"), (None, 2, "assistant", "s")]
    rows += [(8, 0, "user", x) for x in ("x", "y", "y")] + [(8, 1, "assistant", x) for x in ("m", "n", "n")]
    calls, results = cf.conversation_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r.conv, r.kind, r.state, json.loads(r.message), r.n_rows) for r in cf.link(calls, results, cf.CONVERSATION_TOOLS).collect()]
    text = sorted((str(c), kind, state, m["arguments"]["text"] if "arguments" in m else m["content"], n) for c, kind, state, m, n in got)
    assert text == sorted([*[("None", "call", "unanswered", f"q{t}", 1) for t in range(5)], *[("7", "call", "unanswered", x, 1) for x in "ab"],
                           ("None", "result", "orphan", "r", 1), ("None", "result", "orphan", "s", 1), ("8", "call", "linked", "x", 3), ("8", "duplicate_call", "duplicate", "y", 2),
                           ("8", "result", "linked", "m", 3), ("8", "duplicate_result", "duplicate", "n", 2)])


def test_no_python_on_the_main_path(spark):
    calls, results = cf.conversation_calls(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    plan = cf.link(calls, results, cf.CONVERSATION_TOOLS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
