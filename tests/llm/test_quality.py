import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from toolquarry.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(words, size):
    grams = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    hit = set()
    for i in range(len(words) - size + 1):
        if grams[tuple(words[i : i + size])] > 1:
            hit.update(range(i, i + size))
    return len(hit)


def brute(text, least):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    longest = max((k for k in range(least, len(words)) if covered(words, k)), default=0)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": covered(words, 5),
        "n_covered": covered(words, least),
        "longest": longest,
    }


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b ", "ü", "\n", " ", "#x ", "\t"]), max_size=60).map("".join)), max_size=6))
def test_facts_against_brute_force(texts):
    got = Q.repetition_facts(pa.array(texts, pa.string()), 10).to_pylist()
    assert got == [brute(t, 10) for t in texts]


def test_verdicts(documents):
    rng = random.Random(3)
    clean = " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) + str(i) for i in range(900))
    passage = " ".join(f"p{i}" for i in range(101))
    rows = [
        (1, clean),
        (2, clean + " " + passage + " x " + passage),  # base fails? 202 of 1103 words: no; too long a repeat
        (3, "few words"),
        (4, None),
        (5, ""),
        (6, "one line again and again and again\n" * 40),
        (7, clean),
        (7, clean),
    ]
    docs = documents(rows)
    rated = Q.quality(docs)
    assert rated.columns == [*docs.columns, "quality"]
    got = sorted((r["doc_id"], r["quality"]["base_failed"], r["quality"]["kept"]) for r in rated.collect())
    assert got == [
        (1, False, True),
        (2, False, False),
        (3, True, False),
        (4, True, False),
        (5, True, False),
        (6, True, False),
        (7, False, True),
        (7, False, True),
    ]
    assert Q.quality(documents([])).count() == 0


def test_long_text():
    text = " ".join(f"w{i % 50_000}" for i in range(100_000))
    (facts,) = Q.repetition_facts(pa.array([text]), 10).to_pylist()
    assert facts["longest"] == 50_000 and facts["n_covered"] == 100_000


def test_rows_do_not_run_together():
    words = np.arange(30, dtype=np.uint64) % np.uint64(15)
    rows = np.array([0, 15, 30])
    assert Q.longest_repeats(words, rows, 4).max() == 0
