import json

import pytest

from marlstone.llm._shared import LONG_MAX
from marlstone.llm.toolcalls import link, moved

SCHEMAS = {"find": {"q": ("string", True), "n": ("integer", False)}, "sum": {"xs": ("array", True), "deep": ("object", False)}}
CALLS = "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>, extra string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def run(spark, calls, results=()):
    df = spark.createDataFrame([(*c, "x") for c in calls], CALLS)
    rows = link(df, spark.createDataFrame(list(results), RESULTS), SCHEMAS).collect()
    return {(r.conv_id, r.call_id): r for r in rows}


def test_links_and_canonical_json(spark):
    got = run(
        spark,
        [(1, "a", 0, "find", '{"n": 2,  "q": "x\\"\\u00e9"}', []), (1, "b", 2, "sum", '{"xs":[1, 2.5,{"b":1,"a":null}]}', ["a"])],
        [(1, "a", 1, "ok"), (1, "a", 3, "again"), (1, "zzz", 1, "no call"), (2, "b", 1, "another conversation")],
    )
    a, b = got[1, "a"], got[1, "b"]
    assert a.canonical == '{"arguments":{"n":2,"q":"x\\"é"},"id":"a","name":"find","result":"ok"}' and a.result_turn == 1
    assert b.canonical == '{"arguments":{"xs":[1,2.5,{"a":null,"b":1}]},"id":"b","name":"sum","result":null}'
    assert (a.position, b.position, a.errors, b.errors) == (0, 1, [], [])
    json.loads(a.canonical), json.loads(b.canonical)


def test_validation(spark):
    cases = {
        '{"q":"x"}': [], '{"q":1}': ["q is not string"], '{"n":1}': ["missing q"], '{"q":"x","n":1.5,"z":1,"y":2}': ["n is not integer", "unexpected y, z"],
        "[1]": ["not an object"], "{": ["not JSON"], '{"q":"x","n":null}': ["n is not integer"],
    }
    got = run(spark, [(1, f"c{i}", i, "find", a, None) for i, a in enumerate(cases)] + [(1, "n", 9, "find", None, None), (1, "u", 9, "other", "{}", None), (1, "v", 9, None, "{}", None)])
    for i, (a, errors) in enumerate(cases.items()):
        assert got[1, f"c{i}"].errors == errors, a
    assert got[1, "n"].errors == ["not JSON"] and got[1, "u"].errors == ["unknown tool"] == got[1, "v"].errors


def test_topological_order(spark):
    needs = {"a": ["d"], "b": ["a", "e"], "c": [], "d": ["c"], "e": ["c"]}
    calls = [(7, k, i, "find", '{"q":""}', v) for i, (k, v) in enumerate(needs.items())]
    cycle = [(8, "x", 0, "find", "{}", ["y"]), (8, "y", 1, "find", "{}", ["x"]), (8, "z", 2, "find", "{}", ["y"]), (8, "w", 3, "find", "{}", ["gone"])]
    got = run(spark, calls + cycle)
    place = {k: got[7, k].position for k in needs}
    assert sorted(place.values()) == list(range(5)) and all(place[x] < place[k] for k, v in needs.items() for x in v)
    assert {k: got[7, k].level for k in needs} == {"a": 1, "b": 1, "c": 0, "d": 0, "e": 0}
    assert [got[8, k].level for k in "xyzw"] == [None, None, None, 0]
    assert "cycle" in got[8, "x"].errors and "no call gone" in got[8, "w"].errors


def test_a_long_conversation(spark):
    got = run(spark, [(1, f"c{i}", i, "find", '{"q":"x"}', [f"c{i - 1}"] if i else []) for i in range(2500)])
    assert all(got[1, f"c{i}"].position == i for i in range(2500))


def test_odd_rows(spark):
    got = run(spark, [(None, "a", 0, "find", "{}", None), (1, None, 0, "find", "{}", None), (1, "a", None, None, None, None), (1, "b", 1, "find", '{"q":"x"}', ["b"]),
                      (2, "a", 0, "find", '{"q":"x"}', None), (2, "a", 0, "find", '{"q":"x"}', None), (2, "a", 1, "sum", "", None)])
    assert set(got) == {(1, "a"), (1, "b"), (2, "a")}
    assert got[2, "a"].repeats == 3 and got[2, "a"].name == "find"
    assert "cycle" in got[1, "b"].errors
    assert run(spark, []) == {}


def test_query_on_odd_conversations(spark, tmp_path):
    from marlstone.llm.queries import op4_tool_calls

    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", None), (None, 0, "user", "x"), (2, None, "user", "x"), (3, 0, None, ""),
            (4, 0, "user", "t"), (4, 0, "user", "t"), (4, 1, "assistant", "r"), (5, 0, "tool", "x" * 100_000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): r for r in op4_tool_calls(spark, str(tmp_path)).collect()}
    assert set(got) == {(1, 0), (1, 1), (3, 0), (4, 0), (5, 0)}
    assert got[1, 0].position == 1 and got[1, 1].errors == "missing text" and got[4, 0].repeats == 2


def test_rounds_follow_the_moved_calls_and_never_end_early(spark):
    edges = lambda rows: spark.createDataFrame([(*r, 100) for r in rows], "conv_id long, call_id string, turn long, needs string, their_turn long, calls long")
    # A cycle of two and a call after it, among calls that stay: told within a few rounds.
    stay = [(1, f"s{i}", i, f"s{i - 1}", i - 1) for i in range(11, 90)]
    got = {r.call_id: tuple(r.place) for r in moved(edges([(1, "x", 0, "y", 1), (1, "y", 1, "x", 0), (1, "z", 2, "y", 1), *stay]), 12).collect()}
    assert got == {c: (LONG_MAX, 0) for c in "xyz"}
    # A chain of later turns' calls, longer than the rounds, is an error and not left unfinished; with enough it is ordered.
    chain = edges([(1, f"c{i}", i, f"c{i + 1}", i + 1) for i in range(8)])
    with pytest.raises(RuntimeError):
        moved(chain, 4)
    assert {r.call_id: tuple(r.place) for r in moved(chain).collect()} == {f"c{i}": (8, 8 - i) for i in range(8)}
