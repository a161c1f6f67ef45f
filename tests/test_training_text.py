import pytest
from pyspark.sql import functions as F

from toolquarry.operators import training_text as R
from toolquarry.schemas import CATALOG, SAMPLES

OBJECT = '{"type":"object"}'


def m(role, content="", name=None, calls=None):
    return (role, content, name, calls)


@pytest.fixture
def catalog(spark):
    rows = [
        (0, "function", "z", "first", OBJECT, None, None),
        (1, "function", "a", "", None, '{"v":1}', '{"strict":true}'),
        (2, None, "z", None, OBJECT, None, None),
    ]
    return spark.createDataFrame(rows, CATALOG)


Z1 = '{"type":"function","function":{"name":"z","description":"first","parameters":{"type":"object"}}}'
A = '{"type":"function","function":{"name":"a","description":"","strict":true},"v":1}'
Z2 = '{"function":{"name":"z","parameters":{"type":"object"}}}'


def test_instruction_message(spark):
    rows = [
        ("user", None, [m("user", "hi")]),
        ("system", None, [m("system", "s"), m("user")]),
        ("developer", None, [m("developer", "d")]),
        ("empty", None, []),
        ("null", None, None),
        ("later", None, [m("user"), m("system")]),
    ]
    df = R.add_instruction(spark.createDataFrame(rows, SAMPLES))
    got = {r["id"]: [x["role"] for x in r["messages"]] for r in df.collect()}
    assert got == {
        "user": ["developer", "user"],
        "system": ["system", "user"],
        "developer": ["developer"],
        "empty": ["developer"],
        "null": ["developer"],
        "later": ["developer", "user", "system"],
    }
    assert df.filter("id = 'user'").head()["messages"][0]["content"] == R.INSTRUCTION


SELECTIONS = [
    ("null", None, [Z1, A, Z2]),
    ("empty", [], [Z1, A, Z2]),
    ("one", ["a"], [A]),
    ("order", ["a", "z", "a"], [Z1, A, Z2]),
    ("unknown", ["no"], []),
    ("mixed", ["no", "z"], [Z1, Z2]),
    ("null name", [None, "a"], [A]),
]


def test_tool_selection(spark, catalog):
    samples = spark.createDataFrame([(i, names, []) for i, names, _ in SELECTIONS], SAMPLES)
    selected = R.select_tools(samples, catalog)
    assert selected.columns == ["id", "tool_names", "messages", "tools"]
    assert {r["id"]: r["tools"] for r in selected.collect()} == {i: t for i, _, t in SELECTIONS}


def test_the_whole_catalog_is_one_list_and_only_where_it_is_asked_for(spark, catalog):
    named = spark.createDataFrame([("x", ["a"], []), ("y", ["a", "a"], []), ("z", ["no"], [])], SAMPLES)
    assert [tuple(r) for r in R.tool_lists(named, catalog).collect()] == [('["a"]', [A])]
    unnamed = named.unionByName(spark.createDataFrame([("n", None, []), ("m", [], [])], SAMPLES))
    lists = {r["tools_key"]: r["tools"] for r in R.tool_lists(unnamed, catalog).collect()}
    assert lists == {'["a"]': [A], R.ALL_TOOLS: [Z1, A, Z2]}


def test_a_large_catalog_costs_nothing_to_samples_that_name_their_tools(spark):
    text = F.repeat(F.lit("long "), 20_000)
    large = spark.range(3_000).select(  # 300 MB of descriptions
        F.concat(F.lit("t"), "id").alias("name"), F.lit("function").alias("type"), text.alias("description"), F.lit(OBJECT).alias("parameters")
    )
    samples = spark.createDataFrame([("x", ["t7"], [])], SAMPLES)
    (row,) = R.select_tools(samples, large).collect()
    assert len(row["tools"]) == 1 and '"name":"t7"' in row["tools"][0]


def test_no_job_runs_while_a_plan_is_built(spark, catalog):
    samples = spark.createDataFrame([("x", None, [])], SAMPLES)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "")
    try:
        R.format_samples(samples, catalog)
        R.render_chat(R.add_instruction(R.assemble_turns(turns(spark), 3)))
        assert list(tracker.getJobIdsForGroup("plans")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rendering(spark, catalog):
    calls = [(("a", '{"k": 1}'),), (("z", None),)]
    rows = [
        ("s", ["a"], [m("user", "hi"), m("assistant", "", calls=calls), m("tool", "{}", "a"), m("assistant", None)]),
        ("n", ["no"], [m("system", "s")]),
    ]
    texts = R.format_samples(spark.createDataFrame(rows, SAMPLES), catalog)
    got = {r["id"]: r["text"] for r in texts.collect()}
    assert got == {
        "s": f"<tools>{A}</tools>\n<turn:developer>{R.INSTRUCTION}</turn>\n<turn:user>hi</turn>\n"
        '<turn:assistant><call:a>{"k": 1}</call><call:z>{}</call></turn>\n<turn:tool>[a]{}</turn>\n<turn:assistant></turn>\n',
        "n": "<turn:system>s</turn>\n",
    }
    odd = R.ChatTemplate(turn_begin="${env:HOME}'", role_end="\\n: ", turn_end="\n{x}\\")
    short = R.render_chat(spark.createDataFrame(rows[1:], SAMPLES), odd)
    assert short.head()["text"] == "${env:HOME}'system\\n: s\n{x}\\"


TURNS = [
    (1, 5, "assistant", "b"), (1, 4, "user", "a"), (1, 90, "user", "c"),
    (2, 0, "system", "s"), (2, 1, "user", "u"),
    (3, -2, "user", "x"), (3, -1, "developer", "y"),
    *[(4, i, "user", str(i)) for i in range(40)],
]


def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").repartition(5)


@pytest.mark.parametrize("span", [1, 4, 7, 1000])
def test_assembly_keeps_every_turn_in_order(spark, span):
    parts = R.assemble_turns(turns(spark), span).orderBy("conv_id", "part").collect()
    got = {}
    for r in parts:
        assert r["first"] == (r["conv_id"] not in got)
        got.setdefault(r["conv_id"], []).extend((x["role"], x["content"]) for x in r["messages"])
        assert len(r["messages"]) <= span
    want = {}
    for conv, _, role, text in sorted(TURNS):
        want.setdefault(conv, []).append((role, text))
    assert got == want
    assert {(r["conv_id"], r["part"]) for r in parts} == {(c, t // span) for c, t, *_ in TURNS}


def test_instruction_and_tools_stand_once(spark, catalog):
    parts = R.assemble_turns(turns(spark), 10).withColumn("tool_names", F.array(F.lit("a")))
    texts = {}
    for r in R.format_samples(parts, catalog).orderBy("conv_id", "part").collect():
        texts.setdefault(r["conv_id"], []).append(r["text"])
    head = f"<tools>{A}</tools>\n"
    for conv, own in texts.items():
        assert own[0].startswith(head)
        assert "".join(own).count("<tools>") == 1
        assert "".join(own).count(R.INSTRUCTION) == (0 if conv == 2 else 1)
    assert len(texts[4]) == 4 and len(texts[1]) == 2


def test_turns_with_null_and_equal_numbers_are_kept(spark):
    rows = [(None, None, "user", "n"), (None, None, "user", None), (9, 1, "b", "x"), (9, 1, "a", "y"), (9, 1, "a", "y")]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = {r["conv_id"]: [(m["role"], m["content"]) for m in r["messages"]] for r in R.assemble_turns(df, 5).collect()}
    assert got == {None: [("user", None), ("user", "n")], 9: [("a", "y"), ("a", "y"), ("b", "x")]}


def test_budget(spark):
    texts = ["", "  ", "one", " a\tb\nc ", "x y z　w"]
    df = spark.createDataFrame([(t, "g") for t in texts], "text STRING, g STRING")
    got = {r["text"]: (r["n_tokens_proxy"], r["over_budget"]) for r in R.mark_budget(df, 2).collect()}
    assert got == {
        "": (0, False), "  ": (0, False), "one": (1, False), texts[3]: (3, True), texts[4]: (4, True),
    }
    assert tuple(R.budget_counts(df, 2, "g").head()) == ("g", 5, 2)
    assert R.budget_counts(df, 2).select(F.col("texts")).head()["texts"] == 5
