"""Quality rules: base counts of a text, and repetition found by a suffix array.

The suffix array of every text is built over its words (many texts in one numpy pass, told
apart by their row) by sorting prefixes of 1, 2, 4, ... words, going on only where suffixes
still tie. Neighbours in it share a longest common prefix; its intervals are the maximal
repeated substrings. The union of their spans and the longest of them are limited.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix, separators, word_hashes, words
from .work import text_chunks

# Fixed values of the base rules.
SPACE = ((0x20, 0x20), (0x09, 0x0D))
SYMBOLS = "#*$%&|<>"
WINDOW = 5

FACTS = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
    "n_repeat_words:bigint,n_covered:bigint,longest:bigint>"
)
_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest")


def longest_repeats(hashed: np.ndarray, rows: np.ndarray, least: int) -> np.ndarray:
    """For each word the longest prefix of its suffix that occurs again in its own row.

    Only lengths of ``least`` (a power of two) words and more are told; others are 0.
    """
    n = len(hashed)
    longest = np.zeros(n, np.int64)
    if n == 0:
        return longest
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    end = rows[row + 1]
    first = mix(hashed + mix(row.astype(np.uint64) + np.uint64(1)))
    sa = np.argsort(first)
    keys = first[sa]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank = np.empty(n, np.int64)
    rank[sa] = head  # a group's rank is the place of its first suffix
    levels, h = [rank], 1
    tied = ~(new & np.concatenate((new[1:], [True])))
    places = np.flatnonzero(tied)
    while len(places):
        at = sa[places]
        ahead = at + h
        second = np.where(ahead < end[at], rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[at]
        order = np.lexsort((second, group))
        at, group, second = at[order], group[order], second[order]
        sa[places] = at
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        head = places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank = rank.copy()
        rank[at] = head
        levels.append(rank)
        h *= 2
        places = places[~(new & np.concatenate((new[1:], [True])))]
    # Longest common prefixes of neighbours, from the ranks of every level.
    level = least.bit_length() - 1
    if level >= len(levels):
        return longest
    same = levels[level]
    pair = np.flatnonzero(same[sa[:-1]] == same[sa[1:]])
    i, j = sa[pair].copy(), sa[pair + 1].copy()
    shared = np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (i + shared < end[i]) & (j + shared < end[j])
        a, b = np.minimum(i + shared, n - 1), np.minimum(j + shared, n - 1)
        shared += np.where(inside & (levels[k][a] == levels[k][b]), 1 << k, 0)
    np.maximum.at(longest, i, shared)
    np.maximum.at(longest, j, shared)
    return longest


def covered(longest: np.ndarray, least: int, size: int | None = None) -> np.ndarray:
    """Words inside a repeat of ``least`` words or more (its first ``size`` words, if given)."""
    n = len(longest)
    starts = np.flatnonzero(longest >= least)
    ends = starts + (longest[starts] if size is None else size)
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _dup_lines(text: str) -> int:
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\v\f"):
            if line in seen:
                again += 1
            seen.add(line)
    return again


def repetition_facts(texts: pa.Array, least: int) -> pa.Array:
    """One struct of counts per text."""
    table = separators(*SPACE)
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS.encode())] = 1
    out = {name: [] for name in _NAMES}
    for _, data, offsets in text_chunks(texts):
        starts, ends, rows = words(data, offsets, table)
        longest = longest_repeats(word_hashes(data, starts, ends), rows, 4)
        per_row = lambda flags, at: np.diff(np.concatenate(([0], np.cumsum(flags)))[at])
        out["n_words"].append(np.diff(rows))
        out["word_chars"].append(per_row(~table[data] & ((data & 0xC0) != 0x80), offsets))
        out["n_symbols"].append(per_row(symbol[data], offsets))
        out["n_repeat_words"].append(per_row(covered(longest, WINDOW, WINDOW), rows))
        out["n_covered"].append(per_row(covered(longest, least), rows))
        peak = np.zeros(len(rows) - 1, np.int64)
        full = np.flatnonzero(np.diff(rows))
        if len(full):
            peak[full] = np.maximum.reduceat(longest, rows[full])
        out["longest"].append(np.where(peak >= least, peak, 0))
    lines = [_dup_lines(t) if t else 0 for t in texts.to_pylist()]
    columns = [
        pa.array(lines, pa.int64()) if name == "n_dup_lines"
        else pa.array(np.concatenate(out[name]) if out[name] else np.zeros(0, np.int64), pa.int64())
        for name in _NAMES
    ]
    return pa.StructArray.from_arrays(columns, list(_NAMES))


def quality(
    docs: DataFrame,
    text: str = "text",
    least: int = 10,
    max_covered: float = 0.15,
    max_longest: int = 100,
) -> DataFrame:
    """``docs`` with a column ``quality``: the base counts, the repetition, the verdicts.

    A repeat is a sequence of ``least`` words or more that occurs twice in the text
    (overlapping itself or not); ``n_covered`` words lie in one, ``longest`` is the longest
    of them. A text is kept unless the base rules fail, or more than ``max_covered`` of its
    words are covered, or ``longest`` exceeds ``max_longest``.

    A null or empty text has no words and fails the base rules. Rows stay as they are,
    repeated ones included, and so do other columns (a column ``quality`` is replaced). Words
    are compared by 64-bit hashes. A text is handled whole by one task.
    """

    @F.arrow_udf(FACTS)
    def facts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield repetition_facts(texts, least)

    q = F.col("quality")
    failed = (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])
    repetitive = (q["n_covered"] > max_covered * q["n_words"]) | (q["longest"] > max_longest)
    return (
        docs.withColumn("quality", facts.asNondeterministic()(F.col(text)))
        .withColumn("quality", q.withField("base_failed", failed))
        .withColumn("quality", q.withField("kept", ~q["base_failed"] & ~repetitive))
    )
