"""Small tables between the steps go into few files, however many partitions a shuffle has."""

import random
from pathlib import Path

import pytest

from toolquarry.llm import decontam, lines, neardup
from toolquarry.llm.components import components
from toolquarry.llm.work import FILE_ROWS, files_for


@pytest.fixture
def many_partitions(spark):
    """Shuffles into 40 partitions that adaptive execution leaves as they are."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def files(folder, name):
    return len(list((Path(folder) / name).glob("part-*")))


def test_files_grow_with_rows():
    assert [files_for(n) for n in (0, 1, FILE_ROWS, FILE_ROWS + 1, 50 * FILE_ROWS)] == [1, 1, 1, 2, 50]


def test_near_duplicates(documents, many_partitions, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(100):
        words = [f"w{rng.randrange(400)}" for _ in range(60)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], "x"]))]
    found = neardup.near_duplicates(documents(rows), folder=str(tmp_path)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {i: i - i % 2 for i, _ in rows}
    for name in ("nodes", "members_0", "led_0", "found_0", "asked", "rooted_0/large_1", "rooted_0/edges_1"):
        assert files(tmp_path, name) == 1, name
    assert files(tmp_path, "compared") <= neardup.ROUNDS


def test_line_dedup(documents, many_partitions, tmp_path):
    rng = random.Random(6)
    own = lambda n: [f"line {rng.random()}" for _ in range(n)]
    passages = [own(12) for _ in range(60)]
    rows = [(i, "\n".join([*own(3), *passages[i % 60], *own(3)])) for i in range(120)]
    found = lines.repeated_chunks(documents(rows), str(tmp_path)).collect()
    assert found and all(r["doc_id"] >= 60 for r in found)
    assert [files(tmp_path, name) for name in ("repeated", "cover")] == [1, 1]


def test_components(spark, many_partitions, tmp_path):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 400, 2)], "a long, b long")
    assert components(links, str(tmp_path), 200).count() == 400
    assert [files(tmp_path, name) for name in ("edges_0", "large_1", "edges_1")] == [1, 1, 1]


def test_decontamination_needs_one_python_worker_a_task(spark, documents, tmp_path):
    docs = documents([(1, "a b c d e f"), (2, "x")])
    block = decontam._Block([7], ["b c d"], lambda vocabulary: {i: 1 for i in range(len(vocabulary))})
    found = docs.select("doc_id", decontam._hits_of(block)("text").alias("f")).select("doc_id", "f.*")
    assert [(r["n_words"], [tuple(h) for h in r["hits"]]) for r in found.sort("doc_id").collect()] == [(6, [(1, 3, 7)]), (1, [])]
