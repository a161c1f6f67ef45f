import random
import re

import pytest

from toolquarry.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items, size):
    out = set()
    for doc_id, text in rows:
        words, hit, named = split(text), set(), set()
        for item_id, item in items:
            own = split(item)
            k = min(size, len(own))
            for i in range(len(own) - k + 1 if own else 0):
                for j in range(len(words) - k + 1):
                    if words[j : j + k] == own[i : i + k]:
                        hit.update(range(j, j + k))
                        named.add(item_id)
        if hit:
            out.add((doc_id, len(words), len(hit), tuple(sorted(named, key=str))))
    return out


def result(docs, items, size, **more):
    rows = D.contamination(docs, items, size, **more).collect()
    return {(r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["item_ids"], key=str))) for r in rows}


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [3, 50_000])
def test_against_brute_force(spark, documents, monkeypatch, block):
    rng = random.Random(block)
    monkeypatch.setattr(D, "_PAIRS", 7)
    word = lambda: rng.choice(["a", "B", "c7", "É", "the", "the"])
    items = [(i, rng.choice([" ", "-", ", "]).join(word() for _ in range(rng.randint(0, 9)))) for i in range(12)]
    items += [(20, None), (21, items[0][1]), (21, items[0][1])]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(40)]
    got = result(documents(rows), items_table(spark, items), 5, block_windows=block)
    assert got == brute(rows, items, 5)


def test_edge_cases(spark, documents):
    items = [(1, "Ten words in a row make one window of this item, plainly so"), (2, "short item"), (3, ""), (4, "...")]
    passage = items[0][1].upper()
    rows = [
        (1, None),
        (2, ""),
        (3, passage),
        (4, " ".join(passage.split()[:9])),
        (5, "so short, item: found"),
        (6, "filler " * 30_000 + passage),
        (7, passage),
        (7, passage),
        (None, passage),
    ]
    got = result(documents(rows), items_table(spark, items), 10)
    assert got == brute(rows, items, 10)
    kept = D.drop_contaminated(documents(rows), items_table(spark, items))
    assert sorted((r["doc_id"] for r in kept.collect())) == [1, 2, 4]
    assert kept.columns == documents(rows).columns


def test_empty_tables(spark, documents):
    some, none = documents([(1, "a b c")]), items_table(spark, [])
    assert D.contamination(some, none).count() == 0
    assert D.drop_contaminated(some, none).count() == 1
    assert D.contamination(documents([]), items_table(spark, [(1, "a b")])).count() == 0
