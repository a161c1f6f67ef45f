import hashlib
import os
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from toolquarry.llm import lines as L


def cuttings(lines):
    """Ends of chunks under every cutting, line by line."""
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
    number = [int(h[:8], 16) for h in sha]
    final = len(lines) - 1
    yield [i + 1 for i in range(len(lines)) if ((number[i - 1] if i else 0) * 31 + number[i]) % 4 == 0 or i == final]
    for k in range(24):
        yield [
            i + 1 for i in range(len(lines)) if i == final or int(sha[i][2 * k + 1], 16) < 6 or int(sha[i + 1][2 * k], 16) < 6
        ]


def brute(rows):
    """Texts left, comparing the text of every chunk with all before it."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, left = {}, {}
    for doc_id, text in docs:
        own, runs = text.split("\n"), set()
        for ends in cuttings(own):
            runs |= {(a, b) for a, b in zip([0, *ends], ends) if sum(bool(x.strip(L.BLANK)) for x in own[a:b]) > 1}
        gone = set()
        for a, b in sorted(runs):
            if seen.setdefault("\n".join(own[a:b]), (doc_id, text, a)) != (doc_id, text, a):
                gone |= set(range(a, b))
        left[(doc_id, text)] = "\n".join(x for i, x in enumerate(own) if i not in gone)
    return sorted(((i, left.get((i, t), t)) for i, t in rows), key=str)


def result(docs):
    return sorted(((r["doc_id"], r["text"]) for r in L.dedup_lines(docs).collect()), key=str)


BLOCK = "\n".join(f"shared line number {i}" for i in range(40))
ROWS = [
    (1, BLOCK),
    (2, "own head\n" + BLOCK + "\nown tail"),
    (3, "another\nhead here\n" + BLOCK),
    (4, BLOCK.replace("number 20", "number twenty")),
    (5, None),
    (6, ""),
    (7, "one line"),
    (8, "one line"),
    (9, "\n\n\n\n \n\n\t\n\n\n\n\n\n"),
    (10, "\n\n\n\n \n\n\t\n\n\n\n\n\n"),
    (11, "same row\n" * 30),
    (11, "same row\n" * 30),
    (12, "x\ny\r\n" * 20_000),
    (None, BLOCK),
]


def test_against_brute_force(documents):
    assert result(documents(ROWS)) == brute(ROWS)


def test_shared_lines_go_and_own_lines_stay(documents):
    left = dict(result(documents(ROWS[:4])))
    assert left[1] == BLOCK
    # only what shares a chunk with own lines can stay besides them
    assert "own head" in left[2] and "own tail" in left[2] and len(left[2]) < len(BLOCK) / 2
    assert "number twenty" in left[4] and len(left[4]) < len(BLOCK)


def chunk_texts(lines):
    _, first, n, _ = L.multi_line_chunks(["\n".join(lines)], 0)
    return {tuple(lines[a : a + b]) for a, b in zip(first.tolist(), n.tolist())}


def test_boundaries_fall_into_step_again():
    own = BLOCK.split("\n")
    more = ["inserted", *own[:17], "inserted", *own[17:]]
    assert len(chunk_texts(own)) > 5
    assert len(chunk_texts(own) ^ chunk_texts(more)) <= 6


def test_few_runs_cover_all_lines():
    rng = random.Random(3)
    for _ in range(300):
        runs = [{"first": rng.randrange(30), "n": rng.randint(1, 8)} for _ in range(rng.randint(0, 12))]
        lines = lambda some: [i for r in some for i in range(r["first"], r["first"] + r["n"])]
        taken = lines(L.covering(runs))
        assert set(taken) == set(lines(runs))
        assert all(taken.count(i) <= 2 for i in taken)


def test_rows_columns_and_empty_table(documents):
    docs = documents(ROWS)
    left = L.dedup_lines(docs)
    assert left.columns == [*docs.columns, "removed"]
    assert left.count() == len(ROWS)
    assert L.dedup_lines(documents([])).count() == 0


def test_further_cuttings_find_short_passages(documents):
    """Passages of five lines in two documents each."""
    rows = []
    for i in range(40):
        passage = "\n".join(f"passage {i} line {k}" for k in range(5))
        rows += [(2 * i, f"head {i}\n{passage}\ntail {i}"), (2 * i + 1, f"other {i}\n{passage}\nend {i}")]
    found = L.dedup_lines(documents(rows)).collect()
    left = {r["doc_id"]: r["text"].split("\n") for r in found}
    assert all(left[2 * i] == rows[2 * i][1].split("\n") for i in range(40))
    assert all({f"other {i}", f"end {i}"} <= set(left[2 * i + 1]) for i in range(40))
    assert sum(7 - len(left[2 * i + 1]) for i in range(40)) > 100


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables here")
def test_recall_of_repeated_lines(spark):
    """Pairs of lines that stand in an earlier document, counted without any chunk."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.where("text IS NOT NULL").groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")
    runs = {r["doc_id"]: r["removed"] for r in L.dedup_lines(docs).collect()}
    seen, words, found = set(), 0, 0
    for doc_id, text in sorted(map(tuple, docs.collect())):
        own = text.split("\n")
        pairs = [(i, p) for i, p in enumerate(zip(own, own[1:])) if p[0].strip(L.BLANK) and p[1].strip(L.BLANK)]
        repeated = {k for i, p in pairs if p in seen for k in (i, i + 1)}
        seen.update(p for _, p in pairs)
        gone = {k for r in runs[doc_id] for k in range(r["first"], r["first"] + r["n"])}
        words += sum(len(own[k].split()) for k in repeated)
        found += sum(len(own[k].split()) for k in repeated & gone)
    assert words > 1000
    assert found >= 0.9 * words


def test_a_large_batch_is_cut_in_pieces():
    """What a worker holds follows the size of a piece, not that of the batch."""
    rng = random.Random(5)
    texts = ["\n".join(f"line {rng.randrange(10**6)} of it" for _ in range(40)) for _ in range(8_000)]
    tracemalloc.start()
    whole = L._chunks(L.CUTTINGS).func(pa.array(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    for at in (0, 3_999, 7_999):
        _, first, n, digests = L.multi_line_chunks([texts[at]])
        want = zip(first.tolist(), n.tolist(), digests, strict=True)
        assert [tuple(c.values()) for c in whole[at].as_py()] == list(want)
