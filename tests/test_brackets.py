"""Bracket lookups against plain scans, and their time."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from toolquarry.operators import brackets as B
from toolquarry.operators import java_tools, node_tools

PIECES = ["(", ")", "[", "]", "{", "}", ",", "a", " ", "'", '"', "`", "//", "/*", "*/", "\n", "\\", ", ", "tool("]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)


@settings(deadline=None)
@given(TEXTS)
def test_lookups_equal_scans(text):
    code, quotes = B.code_index(text), {p: B.bracket_index(text, dict(p)) for p in ((("(", ")"),), (("{", "}"),), tuple(B.BRACKETS.items()))}
    direct = B.DIRECT
    starts = list(range(len(text) + 1))
    random.Random(len(text)).shuffle(starts)
    want = {}
    for at in starts:
        want[at] = [B.call_arguments(text, at, n) for n in (1, 2, 9)], [B.closing(text, at, dict(p)) for p in quotes]
    try:
        B.DIRECT = -1  # every question goes to the index
        for at in starts:
            got = [B.call_arguments(text, at, n, code) for n in (1, 2, 9)], [B.closing(text, at, dict(p), i) for p, i in quotes.items()]
            assert got == want[at]
    finally:
        B.DIRECT = direct


def seconds(find, text):
    began = time.process_time()
    find(text)
    return time.process_time() - began


CALLS = {
    "unclosed": (node_tools.find, "tool(\"n\"\n"),
    "unclosed in comments": (node_tools.find, "// tool('n'\n{ x([\n"),
    "unclosed in quotes": (node_tools.find, "it's tool(\"n\" [ {\n"),
    "nested": (node_tools.find, "tool([ 'n'\n"),
    "methods": (java_tools.find, "@Tool\nvoid f(int a\n"),
}


@pytest.mark.parametrize("case", CALLS)
def test_time_grows_with_the_text(case):
    find, line = CALLS[case]
    find(line * 100)
    few = min(seconds(find, line * 2000) for _ in range(3))
    many = min(seconds(find, line * 8000) for _ in range(2))
    assert many < 4 * 2 * few + 0.05  # four times the text


def test_long_bodies_are_not_read():
    text = "tool('n', {}, " + "[({,}), ] " * 50_000 + ")"
    index = B.code_index(text)
    assert B.call_arguments(text, 5, 2, index) == ["'n'", "{}"]
    assert not index._ahead
