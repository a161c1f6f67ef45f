import random

from toolquarry.llm.components import components
from toolquarry.llm.work import work_folder


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(500, 560)]
    root = {n: n for link in links for n in link}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = components(spark.createDataFrame(links, "a long, b long"), work_folder(spark))
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in got.collect()} == {n: find(n) for n in linked}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), work_folder(spark)).count() == 0
