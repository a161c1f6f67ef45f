import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from toolquarry.llm import suffixes as S


@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(symbols):
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert S.suffix_array(np.array(symbols, np.int64)).tolist() == want


def test_suffix_array_of_long_repeats():
    symbols = [1, 2, 3] * 500 + [2] * 700
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert S.suffix_array(np.array(symbols, np.int64)).tolist() == want


def brute(rows, size):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter()
    for i, b in {(i, b) for i, b in data}:  # equal rows are one document
        seen.update(b[k : k + size] for k in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return sorted(out, key=str)


def result(docs, size):
    rows = S.remove_bytes(docs, size).select("doc_id", "deduplicated.*").collect()
    return sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in rows), key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    piece = lambda k: "".join(rng.choice("abcé ") for _ in range(k))
    passages = [piece(rng.randint(10, 120)) for _ in range(5)] + ["xy" * 40]
    rows = []
    for i in range(n):
        text = piece(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) - 1)
            text += p[a : a + rng.randint(1, len(p))] + piece(rng.randint(0, 9))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("many", [2, 5])
def test_against_brute_force(documents, monkeypatch, many):
    monkeypatch.setattr(S, "GRAM", 6)
    monkeypatch.setattr(S, "SHARD_BYTES", 200)
    monkeypatch.setattr(S, "BLOCK", 64)
    monkeypatch.setattr(S, "UNIT", many)
    rows = texts(many)
    assert result(documents(rows), 20) == brute(rows, 20)


def test_edge_cases(documents):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdeß") for _ in range(400))
    rows = [
        (1, None),
        (2, ""),
        (3, passage[:100]),
        (4, passage),
        (5, "x" + passage + "y"),
        (6, "ab" * 300),  # repeats itself
        (None, passage[150:]),
        (7, "once " + "".join(rng.choice("uvw") for _ in range(500))),
        (7, "once " + "".join(rng.choice("uvw") for _ in range(500))),
        (8, "".join(rng.choice("qrst") for _ in range(30_000))),
        (9, "a row that stands twice " * 3 + "".join(rng.choice("lmno") for _ in range(300))),
    ]
    rows.append(rows[-1])
    assert result(documents(rows), 200) == brute(rows, 200)


def test_empty_table(documents):
    assert result(documents([]), 200) == []


def test_a_unit_of_many_contexts_is_certified_once(spark, documents, tmp_path):
    """Edited copies of one text share its units; what goes to the shards does not grow with the copies."""
    rng = random.Random(9)
    piece = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = piece(1_000)
    rows = []
    for i in range(120):
        at = rng.randrange(100, 900)
        rows.append((i, base[:at] + f"<{i}>" + base[at:] + piece(30)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), 200) == brute(rows, 200)
    S.repeated_bytes(documents(rows), 200, str(tmp_path)).count()
    runs = spark.read.parquet(str(tmp_path / "pairs")).count()
    assert runs < 7 * len(rows)  # 1187 when every context had its own
