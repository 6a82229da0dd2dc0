import json

from stayline.llm import tool_calls
from stayline.llm.tool_calls import Parameter

SCHEMAS = {"find": (Parameter("q", "string"), Parameter("n", "integer", required=False)), "mix": (Parameter("xs", "array"),)}


def linked(spark, calls, results=(), after=()):
    out = tool_calls.link(
        spark.createDataFrame(list(calls), "conv_id long, turn long, call_id string, name string, arguments string"),
        spark.createDataFrame(list(results), "conv_id long, turn long, call_id string, content string"),
        spark.createDataFrame(list(after), "conv_id long, call_id string, after string"),
        SCHEMAS,
    )
    return out.collect()


def test_levels_order_and_statuses(spark):
    calls = [(1, t, f"c{t}", "find", '{"q": "x"}') for t in range(9)] + [(2, 1, "c1", "find", '{"q":"x"}')]
    after = [(1, "c0", "c5"), (1, "c5", "c3"), (1, "c0", "c3"), (1, "c6", "c7"), (1, "c7", "c6"), (1, "c8", "c7"), (1, "c2", "gone"), (2, "c1", "c5")]
    results = [(1, 4, "c3", "r3"), (1, 0, "c1", "soon"), (1, 20, "nobody", "?"), (1, 30, "c3", "again")]
    rows = linked(spark, calls, results, after)
    by = {(r["conv_id"], r["call_id"]): r for r in rows}
    # A plain search for levels.
    want = {f"c{t}": 0 for t in (1, 2, 3, 4)} | {"c5": 1, "c0": 2, "c6": None, "c7": None, "c8": None}
    assert {i: by[1, i]["level"] for i in want} == want
    assert [by[1, i]["errors"] for i in ("c6", "c2", "c3")] == [["cycle"], ["missing predecessor"], []]
    assert by[2, "c1"]["errors"] == ["missing predecessor"] and by[2, "c1"]["level"] == 0
    assert by[1, "c3"]["status"] == "linked" and by[1, "c3"]["content"] == "r3" and by[1, "c3"]["n_results"] == 2
    assert by[1, "c1"]["status"] == "early" and by[1, "nobody"]["status"] == "orphan" and by[1, "c4"]["status"] == "unanswered"
    place = {r["call_id"]: i for i, r in enumerate(rows) if r["conv_id"] == 1}
    assert place["c3"] < place["c5"] < place["c0"]


def test_arguments_are_validated_and_canonical(spark):
    cases = {
        '{ "q" : "é\\n", "n" : 3 }': [],
        '{"n": "3", "q": "x"}': ["n is no integer"],
        '{"n": 1.5}': ["missing q", "n is no integer"],
        '{"q": null}': ["missing q"],
        '{"q": 5, "b": {"z": [1, {"y": 2, "x": 1}], "a": true}}': ["q is no string", "unknown b"],
        "[1]": ["arguments are no JSON object"],
        '{"q": "x", "q": "y"}': ["arguments are no JSON object"],
        "{broken": ["arguments are no JSON object"],
        None: ["arguments are no JSON object"],
    }
    rows = linked(spark, [(1, i, f"c{i}", "find", text) for i, text in enumerate(cases)])
    got = {r["call_id"]: r for r in rows}
    for i, (text, errors) in enumerate(cases.items()):
        row = got[f"c{i}"]
        assert row["errors"] == errors, text
        if errors != ["arguments are no JSON object"]:
            assert row["arguments"] == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        line = json.loads(row["line"])
        assert list(line) == sorted(line) and line["call_id"] == f"c{i}"
    others = linked(spark, [(1, 1, "a", "mix", '{"xs": []}'), (1, 2, "b", "else", "{}"), (1, 3, "c", None, "{}"), (1, 4, "d", "mix", '{"xs":1}')])
    assert [r["errors"] for r in others] == [[], ["unknown tool else"], ["unknown tool null"], ["xs is no array"]]


def test_nulls_repeats_and_empty_tables(spark):
    call = (1, 5, "a", "find", '{"q":"x"}')
    rows = linked(spark, [call, call, (1, 2, "a", "mix", "{}"), (None, 1, "a", "find", "{}"), (1, 1, None, "find", "{}")], [(None, 2, "a", "r"), (1, 9, "a", None)])
    got = sorted((r["status"], r["n_calls"], r["n_results"], r["name"] or "") for r in rows)
    assert got == sorted([("linked", 3, 1, "mix"), ("unidentified", 1, 0, "find"), ("unidentified", 1, 0, "find"), ("unidentified", 0, 1, "")])
    assert linked(spark, []) == []
    assert [r["status"] for r in linked(spark, [], [(1, 1, "x", "y")])] == ["orphan"]


def test_a_long_chain(spark):
    n = 12
    rows = linked(spark, [(1, n - i, f"c{i}", "find", '{"q":"x"}') for i in range(n)], (), [(1, f"c{i + 1}", f"c{i}") for i in range(n - 1)])
    assert [r["call_id"] for r in rows] == [f"c{i}" for i in range(n)] and rows[-1]["level"] == n - 1


def test_sampled_calls_carry_whole_texts(spark):
    """Sizes 4k to 4k + 3 give the four tools; only "weigh" has no text in its arguments."""
    texts = ["a" * 5996 + "\"" + "b" * (3 + i) for i in range(4)]
    turns = spark.createDataFrame([(1, 2 * i, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    calls = {r["name"]: (len(texts[r["turn"] // 2]), r["arguments"]) for r in tool_calls.sample_exchanges(turns)[0].collect()}
    for tool in ("lookup", "forget"):
        size, arguments = calls[tool]
        assert json.loads(arguments)["query"] in texts and len(json.loads(arguments)["query"]) == size
    size, arguments = calls["count"]
    assert len(json.loads(arguments + "}")["query"]) == size
    assert set(calls) == {"lookup", "count", "weigh", "forget"}
