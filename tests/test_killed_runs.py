"""Runs that die at any step, and are run again."""

import json
from pathlib import Path

import pytest

from toolquarry import sinks
from toolquarry.functions import places
from toolquarry.plans import catalog_from_tree
from toolquarry.schemas import CATALOG, SAMPLES
from toolquarry.sources import read_catalog, read_samples


class Killed(Exception):
    pass


def dying(monkeypatch, module, name, call, after):
    """The ``call``-th call of a function of ``module`` is the last thing that a run does."""
    plain, calls = getattr(module, name), []

    def run(*args, **more):
        calls.append(name)
        if len(calls) == call and not after:
            raise Killed
        result = plain(*args, **more)
        if len(calls) == call:
            raise Killed
        return result

    monkeypatch.setattr(module, name, run)


def batch(spark, *names):
    return spark.createDataFrame([(n, ["t"], []) for n in names], SAMPLES)


def ids(spark, folder):
    return sorted(str(r["id"]) for r in read_samples(spark, f"{folder}/s").collect())


@pytest.mark.parametrize("step", [("_write", 1, False), ("_write", 1, True), ("index_ids", 1, False), ("index_ids", 1, True), ("index_ids", 2, False)])
def test_appending(spark, folder, monkeypatch, step):
    how = {"path": f"{folder}/s", "ids_path": f"{folder}/ids"}
    sinks.append_samples(batch(spark, "a"), **how)
    with monkeypatch.context() as m:
        dying(m, sinks, *step)
        with pytest.raises(Killed):
            sinks.append_samples(batch(spark, "b", "a"), **how)
    sinks.append_samples(batch(spark, "b", "c", "a"), **how)
    assert ids(spark, folder) == ["a", "b", "c"]
    kept = sinks.index_ids(spark, how["path"], how["ids_path"])
    assert sorted(r["id"] for r in kept.collect()) == ["a", "b", "c"]


def test_samples_written_by_others_and_files_that_are_gone(spark, folder):
    how = {"path": f"{folder}/s", "ids_path": f"{folder}/ids"}
    sinks.append_samples(batch(spark, "a"), **how)
    sinks.append_samples(batch(spark, "x"), how["path"])  # without the table of ids
    Path(folder, "s", "more.jsonl").write_text('{"id": "y", "tool_names": [], "messages": []}\n{broken\n')
    sinks.append_samples(batch(spark, "a", "x", "y", "z"), **how)
    stored = spark.read.text(how["path"]).collect()
    assert sorted(json.loads(r["value"])["id"] for r in stored if r["value"] != "{broken") == ["a", "x", "y", "z"]
    sinks.save_samples(batch(spark, "b"), how["path"])  # what was there before is gone
    sinks.append_samples(batch(spark, "a", "b"), **how)
    assert ids(spark, folder) == ["a", "b"]


def test_each_line_is_read_for_its_id_once(spark, folder, monkeypatch):
    how = {"path": f"{folder}/s", "ids_path": f"{folder}/ids"}
    read, plain = [], sinks.ids_by_part
    monkeypatch.setattr(sinks, "ids_by_part", lambda s, files, fmt: read.extend(files) or plain(s, files, fmt))
    for names in (["a"], ["a", "b"], ["b"], ["c", "d"]):
        sinks.append_samples(batch(spark, *names), **how)
    assert len(read) == len(set(read))
    assert ids(spark, folder) == ["a", "b", "c", "d"]


def test_ids_stored_twice_count_once(spark, folder, monkeypatch):
    how = {"path": f"{folder}/s", "ids_path": f"{folder}/ids"}
    sinks.append_samples(batch(spark, "a"), **how)
    Path(folder, "s", "none.jsonl").write_text('{"tool_names": [], "messages": []}\n')
    sinks.append_samples(batch(spark, "b"), **how)
    # a run that died before it could name the files it had read
    files, target = places.file_system(spark, f"{folder}/ids.parts")
    files.delete(target, True)
    sinks.append_samples(batch(spark, "a", "b", "c"), **how)
    assert ids(spark, folder) == ["None", "a", "b", "c"]


def test_a_table_of_ids_without_parts(spark, folder):
    sinks.save_samples(batch(spark, "a"), f"{folder}/s")
    spark.createDataFrame([("a",)], "id STRING").write.parquet(f"{folder}/ids")
    sinks.append_samples(batch(spark, "a", "b"), f"{folder}/s", ids_path=f"{folder}/ids")
    assert ids(spark, folder) == ["a", "b"]


def entry(spark, *names):
    return spark.createDataFrame([(i, "function", n, "d", None, None, None) for i, n in enumerate(names)], CATALOG)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_saving_a_catalog(spark, folder, monkeypatch, fmt):
    path = f"{folder}/catalog" + (".json" if fmt == "json" else "")
    stored = lambda: [r["name"] for r in read_catalog(spark, path, missing_ok=True).orderBy("name").collect()]
    sinks.save_catalog(entry(spark, "old"), path)
    files, target = places.file_system(spark, path)
    with monkeypatch.context() as m:
        dying(m, sinks, "put", 1, False)
        with pytest.raises(Killed):
            sinks.save_catalog(entry(spark, "new"), path)
    assert stored() == ["old"]
    # between the two renames
    files.rename(target, places.file_system(spark, places.beside(path, "old"))[1])
    assert stored() == ["old"]
    files.rename(target, places.file_system(spark, places.beside(path, "old"))[1])
    sinks.save_catalog(entry(spark, "old", "new"), path)
    assert stored() == ["new", "old"]
    # after both, before the old version is deleted
    sinks.save_catalog(entry(spark, "stale"), f"{path}.old-0", fmt)
    assert stored() == ["new", "old"]
    sinks.save_catalog(entry(spark, "last"), path)
    assert stored() == ["last"]
    left = {p.name for p in Path(folder).iterdir() if not p.name.startswith(".")}
    assert left == {Path(path).name}


@pytest.mark.parametrize("end", ["", ".json"])
def test_a_run_over_a_catalog_that_was_moved_aside(spark, folder, end):
    path = f"{folder}/tools{end}"
    Path(folder, "src", "one").mkdir(parents=True)
    Path(folder, "src", "one", "a.py").write_text("@tool\ndef fresh(): pass\n")
    sinks.save_catalog(entry(spark, "kept"), path)
    files, target = places.file_system(spark, path)
    files.rename(target, places.file_system(spark, places.beside(path, "old"))[1])
    run = catalog_from_tree(spark, f"{folder}/src", path, f"{folder}/work")
    assert [r["name"] for r in run.catalog.orderBy("name").collect()] == ["fresh", "kept"]
    assert run.entries == 2


def test_an_array_is_written_by_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(sinks, "beside", lambda path, kind: f"{path}.{kind}-{len(made)}" if not made.append(kind) else None)
    made = []
    catalog = entry(spark, *(f"n{i:04}" for i in range(900)), "n0000", None).repartition(7)
    plan = sinks._json_entries(catalog)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" in plan and "SinglePartition" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with monkeypatch.context() as m:
            m.setattr(sinks, "put", lambda *a: None)
            m.setattr(sinks, "read_catalog", lambda *a, **k: None)
            sinks.save_catalog(catalog, f"{folder}/c.json")
        assert len([p for p in Path(folder, "c.json.new-2").glob("part-*") if p.stat().st_size]) > 1
        names = [e["function"].get("name") for e in json.loads(Path(folder, "c.json.new-1").read_text())]
        assert names == [None, "n0000", *(f"n{i:04}" for i in range(900))]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
