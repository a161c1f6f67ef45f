import json

from pyspark.sql import functions as F

from toolquarry.operators import samples as G
from toolquarry.schemas import SAMPLES
from toolquarry.sources.sample_files import line_ids, parse_lines

BOOKING = json.dumps(
    {
        "type": "object",
        "properties": {
            "guests": {"type": ["integer", "null"]},
            "room": {"type": "object", "properties": {"floor": {"type": "integer"}}},
            "nights": {"type": "array", "items": {"type": "string"}},
            "board": {"enum": ["half", "full"]},
            "note": {"type": "string"},
        },
        "required": ["room", "guests", "board", "nights"],
    }
)
BOOKING_ARGUMENTS = '{"room":{},"guests":1,"board":"half","nights":[]}'


def test_dummy_values(spark):
    cases = {
        '{"type": "string"}': '"example"',
        '{"type": "integer"}': "1",
        '{"type": "number"}': "1.0",
        '{"type": "boolean"}': "true",
        '{"type": "array"}': "[]",
        '{"type": "object"}': "{}",
        '{"type": "odd"}': '"example"',
        '{"type": null}': '"example"',
        '{"type": ["boolean", "null"]}': "true",
        '{"type": []}': '"example"',
        "{}": '"example"',
        "true": '"example"',
        '{"type": "integer", "enum": ["a\\"b", 2]}': '"a\\"b"',
        '{"enum": ["1"]}': '"1"',
        '{"enum": [1]}': "1",
        '{"enum": [1.0]}': "1.0",
        '{"enum": [null]}': "null",
        '{"enum": [false]}': "false",
        '{"enum": [{"z": 1, "a": []}]}': '{"z":1,"a":[]}',
        '{"enum": [[ "x" ]]}': '["x"]',
        '{"enum": [ "x" ]}': '"x"',
        '{"enum": [], "type": "array"}': "[]",
        '{"enum": null, "type": "integer"}': "1",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s STRING")
    assert {r["s"]: r["v"] for r in df.select("s", F.expr(G.dummy_value("s")).alias("v")).collect()} == cases


def test_arguments(spark):
    cases = {
        BOOKING: BOOKING_ARGUMENTS,
        '{"required": ["b", "a", "b"], "properties": {"a": {"type": "integer"}}}': '{"b":"example","a":1}',
        '{"required": ["q\\"é"], "properties": {}}': '{"q\\"é":"example"}',
        '{"required": ["a"], "properties": {"a": {"type": "integer"}, "a": {"type": "array"}}}': '{"a":[]}',
        '{"required": ["a"], "properties": {"a": null}}': '{"a":"example"}',
        '{"required": null, "properties": null}': "{}",
        "{}": "{}",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s STRING")
    assert {r["s"]: r["v"] for r in df.select("s", F.expr(G.dummy_arguments("s")).alias("v")).collect()} == cases
    none = spark.createDataFrame([(None,)], "s STRING")
    assert none.select(F.expr(G.dummy_arguments("s")).alias("v")).head()["v"] == "{}"


def test_sample_record(spark):
    rows = [("book", "Books a room.", BOOKING), ("bare", None, None), ("x", "  \t", "{}")]
    df = G.generate_samples(spark.createDataFrame(rows, "name STRING, description STRING, parameters STRING"))
    assert df.schema.simpleString() == spark.createDataFrame([], SAMPLES).schema.simpleString()
    got = {r["id"]: json.loads(r["j"]) for r in df.select("id", F.to_json(F.struct("*")).alias("j")).collect()}
    messages = got["auto-book-1"].pop("messages")
    assert got["auto-book-1"] == {"id": "auto-book-1", "tool_names": ["book"]}
    assert [m["role"] for m in messages] == ["user", "assistant", "tool", "assistant"]
    assert messages[0]["content"] == "Use the tool `book` to help with: Books a room."
    assert messages[1]["tool_calls"] == [{"function": {"name": "book", "arguments": BOOKING_ARGUMENTS}}]
    assert (messages[2]["name"], messages[2]["content"]) == ("book", '{"ok": true}')
    assert messages[3]["content"] == "Done."
    for name in ("bare", "x"):
        assert got[f"auto-{name}-1"]["messages"][0]["content"] == f"Use the tool `{name}` to help with:"


def test_lines_hold_arguments_as_objects(spark):
    calls = [(("t", '{"z": 1.0, "b": [1]}'),), (("u", "no json"),), (("v", None),)]
    rows = [
        ('i"d', ["t", None], [("assistant", "", None, calls), ("tool", "é\n", "t", None)]),
        (None, None, []),
    ]
    df = spark.createDataFrame(rows, SAMPLES)
    lines = [r["j"] for r in df.select(G.sample_json(df).alias("j")).collect()]
    assert lines == [
        '{"id":"i\\"d","tool_names":["t",null],"messages":[{"role":"assistant","content":"","tool_calls":['
        '{"function":{"name":"t","arguments":{"z": 1.0, "b": [1]}}},{"function":{"name":"u","arguments":"no json"}},'
        '{"function":{"name":"v"}}]},{"role":"tool","name":"t","content":"é\\n"}]}',
        '{"messages":[]}',
    ]


def test_only_unknown_ids_are_new(spark):
    samples = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("", 5), ("c", 6)], "id STRING, n INT")
    known = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "id STRING")
    assert sorted(r["n"] for r in G.new_samples(samples, known).collect()) == [2, 3, 4, 5, 6]


def test_ids_of_lines(spark):
    lines = [
        '{"id": "a", "messages": [{"role": "user", "content": "]}"}]}',
        '\t {"id": 7} \u00a0\t',
        '{"id": "glued"}{"id": "x"}',
        '{"id": "two"},{"id": "x"}',
        '{"id": "tail"} x',
        '{"id": "open"',
        "{'id': 'single'}",
        '[{"id": "list"}]',
        '"text"',
        "5",
        "",
        "   ",
        '{"id": null}',
        '{"no": 1}',
        '{"id": "b", "messages": "odd"}',
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    assert sorted(r["id"] for r in line_ids(df).collect()) == ["7", "a", "b"]
    rows = parse_lines(df.filter(F.col("value").contains('"a"')), SAMPLES).collect()
    assert rows[0]["messages"][0]["content"] == "]}"
