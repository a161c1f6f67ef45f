import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from toolquarry.operators import catalog as C
from toolquarry.schemas import CATALOG, EMPTY_PARAMETERS, TOOL_DEFS
from toolquarry.sources import parse_catalog

X = '{"type":"object","properties":{"days":{"type":"array"},"lowest":{"type":"number"}},"required":["days"]}'
Y = '{"type":"object","properties":{"days":{"type":"integer"}},"required":[]}'


def existing(spark, *rows):
    full = [(i, "function", *r, *[None] * (5 - len(r))) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, CATALOG)


def incoming(spark, *rows):
    full = [("p", "a.py", "python", 0, 0, 0, i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, TOOL_DEFS)


def merged(old, new):
    rows = C.sort_catalog(C.merge_tools(old, new)).collect()
    return [(r["name"], r["description"], r["parameters"]) for r in rows]


def test_each_gap_is_filled_for_itself(spark):
    old = existing(spark, ("tide", "High water", None), ("moon", None, Y), ("wind", "", "{}"), ("swell", "", X))
    new = incoming(spark, ("wind", "", Y), ("moon", "Phases", X), ("tide", "Low water", Y), ("wind", "Gusts", X))
    assert merged(old, new) == [("moon", "Phases", Y), ("swell", "", X), ("tide", "High water", Y), ("wind", "Gusts", Y)]


def test_existing_wins_and_the_first_incoming_fills(spark):
    old = existing(
        spark,
        ("twice", "lost", X),
        ("twice", "last", None),
        ("kept", "kept", X),
        (None, "nameless", X),
        ("", "nameless", X),
        ("alone", None, None),
        ("bare", None, "{}"),
    )
    new = incoming(
        spark,
        ("kept", "ignored", EMPTY_PARAMETERS),
        ("twice", "ignored", X),
        ("new", "", EMPTY_PARAMETERS),
        ("new", "second", X),
        ("new", "third", X),
        ("bare", "", "{}"),
        ("Z", "upper case first", None),
        ("é", "last", X),
    )
    assert merged(old, new) == [
        ("Z", "upper case first", EMPTY_PARAMETERS),
        ("alone", None, None),
        ("bare", None, EMPTY_PARAMETERS),
        ("kept", "kept", X),
        ("new", "second", EMPTY_PARAMETERS),
        ("twice", "last", X),
        ("é", "last", X),
    ]
    assert C.nameless_entries(old).head()["nameless"] == 2


def test_discovery_order_decides_between_incoming(spark):
    rows = [
        ("p", "b.py", "python", 0, 0, 0, 0, "t", "b", X),
        ("p", "a.java", "java", 2, 0, 0, 0, "t", "java", X),
        ("p", "z.ts", "node", 1, 0, 0, 0, "t", "ts", X),
        ("p", "a.js", "node", 1, 1, 0, 0, "t", "js", X),
        ("p", "a.py", "python", 0, 0, 1, 0, "t", "tool call", X),
        ("p", "a.py", "python", 0, 0, 0, 10, "t", "ten", X),
        ("p", "a.py", "python", 0, 0, 0, 9, "t", "nine", X),
    ]
    new = spark.createDataFrame(rows, TOOL_DEFS)
    assert merged(existing(spark), new) == [("t", "nine", X)]


def by_the_rule(old, new):
    """The last existing value if it is filled, else the first filled incoming one, else what there is."""

    def value(name, field, empty):
        kept = [r[field] for r in old if r[0] == name][-1:]
        offered = [r[field] for r in new if r[0] == name]
        filled = [v for v in kept + offered if v not in empty]
        return (filled or kept or offered)[0]

    names = {r[0] for r in old + new} - {None, ""}
    return [(n, value(n, 1, (None, "")), value(n, 2, (None, "{}"))) for n in sorted(names)]


NAMES = st.sampled_from(["a", "b", "B", "é", "c d"])
OLD = st.lists(st.tuples(NAMES | st.none() | st.just(""), st.sampled_from([None, "", "x", "y"]), st.sampled_from([None, "{}", X])))
NEW = st.lists(st.tuples(NAMES, st.sampled_from(["", "p", "q"]), st.sampled_from([EMPTY_PARAMETERS, X])))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(OLD, NEW)
def test_merge_follows_the_rule(spark, old, new):
    once = C.merge_tools(existing(spark, *old), incoming(spark, *new).repartition(3))
    rows = [(r["name"], r["description"], r["parameters"]) for r in C.sort_catalog(once).collect()]
    assert rows == by_the_rule(old, new)
    # Merging the same tools again changes nothing.
    again = [(n, d, p) for n, d, p in rows]
    assert merged(existing(spark, *again), incoming(spark, *new)) == rows


def test_entries_and_counts(spark):
    new = incoming(spark, ("a", None, None), ("b", "d", "{}"), ("c", "d", X))
    rows = C.to_entries(new).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [
        ("function", "a", "", EMPTY_PARAMETERS),
        ("function", "b", "d", EMPTY_PARAMETERS),
        ("function", "c", "d", X),
    ]
    assert C.catalog_counts(new, "lang").collect()[0]["tools"] == 3
    assert C.catalog_counts(new).collect()[0]["tools"] == 3


def test_params(spark):
    parameters = json.dumps(
        {
            "type": "object",
            "properties": {
                "z.1": {"type": ["integer", "null"], "description": "d"},
                "a": {"type": "string", "enum": ["1", 1, 1.0, None, {"k": [1]}]},
                "none": None,
                "odd": True,
            },
            "required": ["a", "gone"],
        }
    )
    odd = ['{"properties": null, "required": null}', "{}", "not json", None, '{"properties": {"a": {}, "a": {"type": "array"}}}']
    old = existing(spark, ("t", "", parameters), *[(f"o{i}", "", p) for i, p in enumerate(odd)])
    rows = C.tool_params(old).orderBy("name", "ord").collect()
    assert [tuple(r) for r in rows] == [
        ("o4", "a", 0, "array", "", None, False),
        ("t", "z.1", 0, "integer", "d", None, False),
        ("t", "a", 1, "string", "", ['"1"', "1", "1.0", "null", '{"k":[1]}'], True),
        ("t", "none", 2, "string", "", None, False),
        ("t", "odd", 3, "string", "", None, False),
    ]


DOCUMENT = """
[
  {"type": "function", "v": [1, "x"], "function": {"name": "n", "strict": true,
   "description": "d é", "parameters": {"z": 1, "b": {"y": [1, 2.5], "a": null}}}},
  {"function": {"name": "bare"}},
  {"type": "function"},
  {"type": "function", "function": {"name": "nulls", "description": null, "parameters": null}}
]
"""


def test_catalog_documents(spark):
    rows = parse_catalog(spark.createDataFrame([(DOCUMENT,)], "value STRING")).orderBy("ord").collect()
    assert [tuple(r) for r in rows] == [
        (0, "function", "n", "d é", '{"z":1,"b":{"y":[1,2.5],"a":null}}', '{"v":[1,"x"]}', '{"strict":true}'),
        (1, None, "bare", None, None, None, None),
        (2, "function", None, None, None, None, None),
        (3, "function", "nulls", None, None, None, None),
    ]


@pytest.mark.parametrize("text", ['{"a": 1}', "null", "", "[1", "7", "['a']"])
def test_a_catalog_must_be_a_list(spark, text):
    with pytest.raises(Exception, match="JSON list"):
        parse_catalog(spark.createDataFrame([(text,)], "value STRING")).collect()
