import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from toolquarry.llm import packing as P
from toolquarry.llm.queries import op1_packing

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    " ",
    "plain words, don't we'll",
    "\t\r\n \x00 mixed   blanks\n\n  ",
    "añ ß 日本語 😀👍🏽 ſK İ",
    "before <|endoftext|> after",
    "a" * 3000,
    "word " * 2500,
    "same text",
    "same text",
]


def reference_ids(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [P.END_ID]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_tokenizers_library(text):
    assert [*P.token_encoder(FILE)(text or "").tolist(), P.END_ID] == reference_ids(text)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=30))
def test_patterns_place_every_length_once(histogram):
    patterns = P.pack_patterns(histogram, 64)
    placed = Counter()
    for packs, pattern in patterns:
        assert packs > 0
        assert sum(length * times for length, times in pattern) <= 64
        for length, times in pattern:
            placed[length] += packs * times
    assert placed == Counter(histogram)


def test_patterns_waste_little():
    rng = np.random.default_rng(0)
    histogram = Counter(rng.integers(1, 1025, 50_000).tolist())
    used = sum(n * k for n, k in histogram.items())
    assert used / (1024 * sum(n for n, _ in P.pack_patterns(histogram, 1024))) > 0.99


def check(pieces, documents, max_tokens):
    """Every id in exactly one piece, sequences gapless and within bounds."""
    want = Counter()
    for doc_id, text in documents:
        want[(doc_id, tuple(reference_ids(text)))] += 1
    by_doc = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] <= max_tokens
        by_doc[(p["doc_id"], p["doc_tokens"])].append((p["start"], tuple(ids.tolist())))
    assert sum(n for *_, n in ((k, v) for k, v in want.items())) == len(documents)
    total = Counter()
    for (doc_id, _), n in want.items():
        total[doc_id] += n
    got_tokens = sum(p["length"] for p in pieces)
    assert got_tokens == sum(len(ids) * n for (_, ids), n in want.items())
    for (doc_id, ids), n in want.items():
        own = Counter(by_doc[(doc_id, len(ids))])
        for start in range(0, len(ids), max_tokens):
            assert own[(start, ids[start : start + max_tokens])] >= n
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= max_tokens


@pytest.mark.parametrize("max_tokens", [16, 1024])
def test_pack(documents, max_tokens):
    rows = [(i // 2 if i < 20 else None, t) for i, t in enumerate(TEXTS + TEXTS[-2:])] + [(5, "same text")] * 3
    packed = P.pack(documents(rows).repartition(3), FILE, max_tokens)
    pieces = [r.asDict() for r in packed.collect()]
    check(pieces, rows, max_tokens)
    filled = P.sequences(packed).collect()
    assert sum(r["n_tokens"] for r in filled) == sum(p["length"] for p in pieces)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in filled)


def test_empty_table(documents):
    assert P.pack(documents([]), FILE).collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = op1_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = {k: np.array(reference_ids(t), "<u4") for k, t in texts.items()}
    seen = defaultdict(int)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        seen[r["doc_id"]] += r["length"]
    assert seen == {k: len(v) for k, v in ids.items()}
