"""Reading and writing files, and the three runs end to end."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from toolquarry import sinks
from toolquarry.plans import catalog_from_tree, discover_tools, samples_from_catalog, training_text
from toolquarry.schemas import CATALOG, SAMPLES
from toolquarry.sources import known_ids, list_tree, read_catalog, read_samples, read_tree, read_valid_samples

PYTHON = "class X: pass\n\n@mcp.tool('py_tool')\ndef f(q: str):\n    \"\"\"About python.\"\"\"\n"
NODE = "server.registerTool('js_tool', { description: 'About node', inputSchema: z.object({ q: z.string() }) }, f);\n"
JAVA = '@McpTool(name = "java_tool")\npublic String f(String q, int n) { }\n'


def write(root, files):
    for path, text in files.items():
        target = Path(root, path)
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(text if isinstance(text, bytes) else text.encode())


@pytest.fixture
def tree(folder):
    root = f"{folder}/src"
    write(
        root,
        {
            "one/py/__init__.py": PYTHON,
            "one/node/index.js": NODE,
            "one/java/.hidden/Tools.java": JAVA,
            "one/node_modules/m/index.js": "tool('skipped')",
            "one/deep/a/b/c/d/_private.py": "@tool\ndef deep(): pass\n",
            "one/bad.py": b"@tool\ndef f(): pass # \xff\n",
            "two/view.tsx": "tool('not_detected')",
            "three/view.tsx": "tool('detected')",
            "three/package.json": "{}",
            "stray.py": PYTHON,
        },
    )
    os.symlink(f"{root}/one", f"{root}/one/loop")
    return root


@pytest.mark.parametrize("tasks", [1, 16])
def test_every_file_is_listed_once(spark, tree, folder, tasks):
    rows = list_tree(spark, tree, f"{folder}/work", tasks=tasks).collect()
    assert sorted((r["project"], r["path"]) for r in rows) == [
        ("", "stray.py"),
        ("one", "bad.py"),
        ("one", "deep/a/b/c/d/_private.py"),
        ("one", "java/.hidden/Tools.java"),
        ("one", "node/index.js"),
        ("one", "node_modules/m/index.js"),
        ("one", "py/__init__.py"),
        ("three", "package.json"),
        ("three", "view.tsx"),
        ("two", "view.tsx"),
    ]
    assert all(r["length"] == os.path.getsize(r["uri"]) for r in rows)


def test_excluded_folders_are_not_entered(spark, tree, folder):
    paths = {r["path"] for r in list_tree(spark, tree, f"{folder}/work", ["node_modules", "deep", "one"]).collect()}
    assert "node/index.js" in paths and "node_modules/m/index.js" not in paths and len(paths) == 7


def test_a_missing_root_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        list_tree(spark, f"{folder}/none", f"{folder}/work")
    with pytest.raises(FileNotFoundError):
        catalog_from_tree(spark, f"{folder}/none", f"{folder}/tools.json", f"{folder}/work")


def test_one_folder_is_one_project(spark, folder):
    write(f"{folder}/src", {"app.py": PYTHON, "package.json": "{}", "ui/view.tsx": "tool('seen')", "build/x.py": "@tool\ndef no(): pass\n"})
    run = catalog_from_tree(spark, f"{folder}/src", f"{folder}/c", f"{folder}/work", project="mine")
    assert [r["name"] for r in run.catalog.orderBy("name").collect()] == ["py_tool", "seen"]
    assert (run.entries, run.dropped) == (2, 0)
    listed = list_tree(spark, f"{folder}/src", f"{folder}/work", ["build"], "mine").collect()
    assert {r["path"] for r in listed} == {"app.py", "package.json", "ui/view.tsx"}


@pytest.mark.parametrize("languages", ["auto", "python"])
def test_projects_may_be_named_like_excluded_folders(spark, folder, languages):
    names = ("build", "env", "target")
    write(f"{folder}/src", {f"{n}/a.py": f"@tool\ndef {n}(): pass\n" for n in names})
    write(f"{folder}/src", {"build/build/b.py": "@tool\ndef below(): pass\n"})
    run = catalog_from_tree(spark, f"{folder}/src", f"{folder}/c", f"{folder}/work", languages)
    assert sorted(r["name"] for r in run.catalog.collect()) == sorted(names)


def test_files_of_one_folder_are_read_by_several_tasks(spark, folder):
    write(f"{folder}/src", {f"one/f{i:03}.py": f"@tool\ndef f{i}(): pass\n" for i in range(200)})
    files = read_tree(spark, f"{folder}/src", f"{folder}/work", partitions=8)
    sizes = [r["n"] for r in files.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200 and len(sizes) == 8 and max(sizes) < 60


def test_contents(spark, tree, folder, monkeypatch):
    import toolquarry.sources.source_tree as source_tree

    monkeypatch.setattr(source_tree, "_BATCH_BYTES", 60)
    got = {(r["project"], r["path"]): bytes(r["content"]) for r in read_tree(spark, tree, f"{folder}/work", partitions=2).collect()}
    assert len(got) == 10
    for (project, path), content in got.items():
        assert content == Path(tree, project, path).read_bytes()


def test_tree_to_text(spark, tree, folder):
    catalog_path, samples_path = f"{folder}/catalog", f"{folder}/samples"
    work = f"{folder}/work"
    stored = catalog_from_tree(spark, tree, catalog_path, work).catalog
    assert [r["name"] for r in stored.orderBy("name").collect()] == ["deep", "detected", "java_tool", "js_tool", "py_tool"]

    samples_from_catalog(spark, catalog_path, samples_path)
    samples = read_samples(spark, samples_path)
    assert samples.count() == 5
    texts = {r["id"]: r for r in training_text(spark, samples_path, catalog_path, work, budget=10).collect()}
    text = texts["auto-py_tool-1"]["text"]
    assert text.startswith('<tools>{"type":"function","function":{"name":"py_tool","description":"About python."')
    assert '<call:py_tool>{"q":"example"}</call>' in text
    assert texts["auto-py_tool-1"]["over_budget"]

    # A second run over the same tree changes nothing; appending adds nothing.
    before = sorted(map(str, stored.collect()))
    assert sorted(map(str, catalog_from_tree(spark, tree, catalog_path, work).catalog.collect())) == before
    samples_from_catalog(spark, catalog_path, samples_path, append=True)
    assert read_samples(spark, samples_path).count() == 5


def test_skipped_files_are_stored(spark, tree, folder):
    catalog_from_tree(spark, tree, f"{folder}/c", f"{folder}/work", skipped_path=f"{folder}/skipped")
    skipped = spark.read.parquet(f"{folder}/skipped").collect()
    assert [(r["path"], r["reason"]) for r in skipped] == [("bad.py", "bad_utf8")]


def test_fixed_languages_and_excludes(spark, tree, folder):
    run = catalog_from_tree(spark, tree, f"{folder}/c", f"{folder}/work", "node, cobol", ["node"])
    names = [r["name"] for r in run.catalog.orderBy("name").collect()]
    assert names == ["detected", "not_detected", "skipped"]


def test_a_table_of_files_is_an_equal_input(spark, tree, folder):
    scanned = discover_tools(read_tree(spark, tree, f"{folder}/work"))
    names = sorted(t["name"] for r in scanned.collect() for t in r["tools"] or [])
    assert names == ["deep", "detected", "java_tool", "js_tool", "py_tool", "py_tool"]
    assert [r["path"] for r in scanned.filter("reason is not null").collect()] == ["bad.py"]


EXISTING = [
    {"type": "function", "meta": {"z": 1.0, "a": [2, "é"]}, "function": {"name": "py_tool", "description": "Mine", "parameters": None}},
    {"type": "function", "function": {"name": "old", "description": "q\"", "parameters": {"b": 1, "a": {}}, "strict": True}},
    {"type": "function", "function": {"description": "nameless"}},
]


def test_a_json_catalog_stays_a_json_file(spark, tree, folder):
    path = f"{folder}/tools.json"
    write(folder, {"tools.json": json.dumps(EXISTING, indent=2)})
    run = catalog_from_tree(spark, tree, path, f"{folder}/work")
    assert (run.entries, run.dropped) == (6, 1)
    first = Path(path).read_text()
    entries = json.loads(first)
    assert [e["function"]["name"] for e in entries] == ["deep", "detected", "java_tool", "js_tool", "old", "py_tool"]
    assert entries[4] == EXISTING[1] and '"parameters":{"b":1,"a":{}},"strict":true' in first
    assert entries[5]["function"]["description"] == "Mine" and "q" in entries[5]["function"]["parameters"]["properties"]
    assert '"meta":{"z":1.0,"a":[2,"é"]}' in first.replace(" ", "")
    again = catalog_from_tree(spark, tree, path, f"{folder}/work")
    assert Path(path).read_text() == first and again.dropped == 0
    assert sorted(p.name for p in Path(folder).glob("tools.json*")) == ["tools.json"]


def test_a_catalog_never_replaces_the_other_format(spark, folder):
    catalog = spark.createDataFrame([(0, "function", "n", "d", None, None, None)], CATALOG)
    sinks.save_catalog(catalog, f"{folder}/a.json")
    sinks.save_catalog(catalog, f"{folder}/b")
    for path, fmt in ((f"{folder}/a.json", "parquet"), (f"{folder}/b", "json")):
        with pytest.raises(ValueError, match="other format"):
            sinks.save_catalog(catalog, path, fmt)
    with pytest.raises(ValueError, match="json or parquet"):
        sinks.save_catalog(catalog, f"{folder}/c", "csv")
    assert read_catalog(spark, f"{folder}/a.json").count() == read_catalog(spark, f"{folder}/b").count() == 1


def test_missing_catalog(spark, folder):
    for name in ("none.json", "none"):
        assert read_catalog(spark, f"{folder}/{name}", missing_ok=True).count() == 0
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read_catalog(spark, f"{folder}/{name}").count()


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_stored_catalogs_are_read_back(spark, folder, fmt):
    rows = [(i, "function", f"n{i:03}é", 'q"', '{"a": [1]}', '{"x":1}', None) for i in range(50)]
    catalog = spark.createDataFrame(rows, CATALOG).repartition(5)
    stored = sinks.save_catalog(catalog, f"{folder}/out", fmt)
    got = sorted((tuple(r)[1:] for r in stored.select(*catalog.columns).collect()), key=str)
    assert [(*g[:3], g[3].replace(" ", ""), *g[4:]) for g in got] == [(*r[1:4], '{"a":[1]}', *r[5:]) for r in rows]
    again = sinks.save_catalog(stored.where("name < 'n010'"), f"{folder}/out", fmt)  # derived from itself
    assert again.count() == 10
    assert sinks.save_catalog(stored.limit(0), f"{folder}/empty.json").count() == 0
    assert json.loads(Path(folder, "empty.json").read_text()) == []


def test_null_and_repeated_names_give_one_json_array(spark, folder):
    rows = [(i, "function", name, "d", None, None, None) for i, name in enumerate([None, "a", "a", "b", None])]
    sinks.save_catalog(spark.createDataFrame(rows, CATALOG), f"{folder}/odd.json")
    entries = json.loads(Path(folder, "odd.json").read_text())
    assert [e["function"].get("name") for e in entries] == [None, None, "a", "a", "b"]


SAMPLE_LINES = (
    '{"id": "s1", "tool_names": ["t"], "messages": [{"role": "assistant", "content": "", '
    '"tool_calls": [{"function": {"name": "t", "arguments": {"z": 1, "b": [1, 2]}}}]}]}\n'
    '{"id": 7, "tool_names": null, "messages": []}\n'
)


def test_samples_keep_raw_arguments(spark, folder):
    write(folder, {"s.jsonl": SAMPLE_LINES})
    rows = read_samples(spark, f"{folder}/s.jsonl").collect()
    assert rows[0]["messages"][0]["tool_calls"][0]["function"]["arguments"] == '{"z": 1, "b": [1, 2]}'
    assert rows[1]["id"] == "7"


def test_malformed_lines(spark, folder):
    write(folder, {"s.jsonl": SAMPLE_LINES + "\n{broken\n[1]\n" + '{"id": "x"}{"id": "y"}'})
    path = f"{folder}/s.jsonl"
    assert sorted(r["id"] for r in read_valid_samples(spark, path).collect()) == ["7", "s1"]
    assert sorted(r["id"] for r in known_ids(spark, path).collect()) == ["7", "s1"]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_samples(spark, path).collect()


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_append(spark, folder, fmt):
    def ids():
        return sorted(str(r["id"]) for r in read_samples(spark, f"{folder}/s", fmt).collect())

    def batch(*names):
        return spark.createDataFrame([(n, ["t"], []) for n in names], SAMPLES)

    sinks.append_samples(batch("a", "b"), f"{folder}/s", fmt)
    assert ids() == ["a", "b"]
    sinks.append_samples(batch("b", "c", "c", None), f"{folder}/s", fmt)
    assert ids() == ["None", "a", "b", "c", "c"]
    sinks.save_samples(batch("z"), f"{folder}/s", fmt)
    assert ids() == ["z"]


def test_samples_are_stored_as_lines_with_objects(spark, folder):
    write(folder, {"s/part-0.jsonl": SAMPLE_LINES})
    calls = [(("t", '{"x": 1}'),)]
    more = spark.createDataFrame([("s1", ["t"], []), ("s2", ["t"], [("assistant", "", None, calls)])], SAMPLES)
    sinks.append_samples(more, f"{folder}/s")
    lines = [json.loads(x) for p in Path(folder, "s").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(str(x["id"]) for x in lines) == ["7", "s1", "s2"]
    (new,) = [x for x in lines if x["id"] == "s2"]
    assert new["messages"][0]["tool_calls"] == [{"function": {"name": "t", "arguments": {"x": 1}}}]
    assert read_samples(spark, f"{folder}/s").count() == 3


def test_ids_of_stored_samples_may_be_kept_beside_them(spark, folder):
    def batch(*names):
        return spark.createDataFrame([(n, ["t"], []) for n in names], SAMPLES)

    def append(*names):
        sinks.append_samples(batch(*names), f"{folder}/s", ids_path=f"{folder}/ids", work_path=f"{folder}/work")
        return sorted(str(r["id"]) for r in read_samples(spark, f"{folder}/s").collect())

    sinks.save_samples(batch("a", None), f"{folder}/s")
    assert append("a", "b") == ["None", "a", "b"]
    assert append("b", "c", None) == ["None", "None", "a", "b", "c"]
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/ids").collect()) == ["a", "b", "c"]
