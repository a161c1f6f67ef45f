import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from toolquarry.llm import substrings as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """Words left of each row, by comparing all windows."""
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for doc_id, words in split:
        if doc_id is not None:
            for i in range(len(words) - size + 1):
                key = tuple(words[i : i + size])
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, words in split:
        gone = set()
        if doc_id is not None:
            for i in range(len(words) - size + 1):
                if first[tuple(words[i : i + size])] < doc_id:
                    gone.update(range(i, i + size))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def result(docs, size):
    rows = S.remove_passages(docs, size).select("doc_id", "deduplicated.*").collect()
    return sorted((tuple(r) for r in rows), key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é", "der", "x1"]) * rng.randint(1, 3)
    passages = [[word() for _ in range(rng.randint(8, 60))] for _ in range(5)]
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) - 1)
            words += p[a : a + rng.randint(1, len(p))]
            words += [word() for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "\n", "\t \r"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, monkeypatch, seed):
    monkeypatch.setattr(S, "GRAM", 4)
    monkeypatch.setattr(S, "SHARD_WORDS", 50)
    monkeypatch.setattr(S, "TASK_WORDS", 40)
    monkeypatch.setattr(S, "BLOCK", 20)
    rows = texts(seed)
    assert result(documents(rows), 12) == brute(rows, 12)


def test_edge_cases(documents):
    passage = " ".join(f"w{i}" for i in range(70))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, passage),
        (5, "lead " + passage + " tail"),
        (5, "lead " + passage + " tail"),  # repeated row
        (6, " ".join(passage.split()[:49])),  # one word short
        (None, passage),  # takes no part
        (7, "again " * 5000),  # long, repeats only itself
        (8, passage + " " + passage),
    ]
    assert result(documents(rows), 50) == brute(rows, 50)


def test_empty_table(documents):
    assert result(documents([]), 50) == []


def test_rows_and_columns_stay(documents):
    docs = documents([(1, "a b"), (1, "a b"), (2, None)])
    left = S.remove_passages(docs)
    assert left.columns == [*docs.columns, "deduplicated"]
    assert left.drop("deduplicated").exceptAll(docs).count() == 0 and left.count() == 3


def test_automaton_knows_the_smallest_id():
    automaton = S.Automaton()
    automaton.add(list("abcab"), 5)
    automaton.add(list("xbcaby"), 3)
    automaton.finish()
    assert automaton.matches(list("zbcabcab"), 3, 4) == [4, 5, 7, 8]
    assert automaton.matches(list("zbcabcab"), 3, 6) == [4, 5, 6, 7, 8]
    assert automaton.matches(list("abc"), 3, 5) == []


def test_windows_are_hashed_a_piece_of_the_batch_at_a_time():
    texts = [" ".join(f"w{(i * 7 + k) % 311}" for k in range(200)) for i in range(2_000)]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("context", pa.int64())]))
    runs = [[{"start": a, "n": 15, "anchor": i, "context": a} for a in range(0, 150, 15)] for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(runs, kind)], ["text", "runs"])
    tracemalloc.start()
    found = sum(len(x) for x in S._window_rows(50)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 2_000 * 150 and peak < 12e6
    rows = [r for x in S._window_rows(50)([batch.slice(0, 1)]) for r in x.to_pylist()]
    values, _ = S.word_units(np.frombuffer(texts[0].encode(), np.uint8), np.array([0, len(texts[0])]))
    assert [r["context"] + r["i"] for r in rows] == list(range(150))
    want = S.window_hashes(values, np.arange(150), 50).view(np.int64).tolist()
    assert [r["window"] for r in rows] == want
