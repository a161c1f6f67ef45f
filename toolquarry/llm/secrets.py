"""Secret scans: keyword automaton, anchored patterns near its hits, embedded checksums.

One Aho-Corasick automaton holds a necessary keyword of every rule. A pattern is tried only
where a keyword says it could begin, anchored there, so no pattern walks over a text. What
carries a checksum of its own is reported only if that holds.
"""

import base64
import binascii
import itertools
import json
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base rules, in the order of their listing.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# Any four characters of a run of hexadecimal digits are one of these keywords.
HEX_WORDS = tuple(map("".join, itertools.product("0123456789abcdef", repeat=4)))

# Tokens that end in six base-62 digits of the CRC-32 of their middle.
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
CHECKED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
SIGNED_HEAD = re.compile(r"[A-Za-z0-9_-]+")
SIGNED_TAIL = re.compile(r"\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
PRIVATE = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase

KINDS = ("assign", "access", "hex", "checked", "signed", "private")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def crc_digits(middle: str) -> str:
    """CRC-32 of a token's middle as six base-62 digits."""
    n, digits = binascii.crc32(middle.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits


_LOOK = 64  # characters that tell most parts that are no JSON


def _begins_json(part: str) -> bool:
    """False if the first ``_LOOK`` characters of a part show that it is no JSON."""
    start = base64.urlsafe_b64decode(part).decode(errors="replace")
    try:
        json.loads(start)
    except json.JSONDecodeError as e:
        # What the cut may have caused proves nothing: an open string, or anything near the end.
        return e.msg.startswith("Unterminated") or e.pos > len(start) - 16
    return False  # a whole document, and more after it


def _json_part(text: str, start: int, end: int) -> bool:
    try:
        if end - start > _LOOK and not _begins_json(text[start : start + _LOOK]):
            return False
        part = text[start:end]
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (ValueError, RecursionError):
        return False


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    groups = (
        ("assign", ASSIGN_WORDS),
        ("access", ("akia",)),
        ("hex", HEX_WORDS),
        ("checked", CHECKED_WORDS),
        ("signed", ("eyj",)),
        ("private", ("-----begin",)),
    )
    for kind, keywords in groups:
        for keyword in keywords:
            found.add_word(keyword, (kind, len(keyword)))
    found.make_automaton()
    return found


def find_secrets(text: str, automaton) -> list[tuple[str, int, int]]:
    """Spans ``kind, start, end`` (code points, end exclusive), by start, then kind as listed."""
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = text.translate(_LOWER)
    spans = []
    over = dict.fromkeys(KINDS, 0)  # no match of a kind begins before the end of its last
    head_end, tail = 0, None  # of the run of base-64 letters that signed tokens begin in
    for last, (kind, size) in automaton.iter(lowered):
        start = last + 1 - size
        if start < over[kind]:
            continue
        if kind == "hex":
            # All digits before a run's first hit were tried: it cannot begin further left,
            # but capital letters are no digits here.
            match = HEX.match(text, start)
            if match is None:
                continue
            over[kind] = match.end()
            if match.end() - start >= LEAST[kind]:
                spans.append((kind, start, match.end()))
        elif kind == "assign":
            if (match := ASSIGN.match(text, start)) is not None:
                over[kind] = match.end()
                if len(match[2]) >= LEAST[kind]:
                    spans.append((kind, start, match.end()))
        elif kind == "access":
            if (match := ACCESS.match(text, start)) is not None:
                over[kind] = match.end()
                if match.end() - start >= LEAST[kind]:
                    spans.append((kind, start, match.end()))
        elif kind == "checked":
            match = CHECKED.match(text, start)
            if match is not None and crc_digits(match[1]) == match[2]:
                over[kind] = match.end()
                spans.append((kind, start, match.end()))
        elif kind == "signed":
            if not text.startswith("eyJ", start):
                continue
            if start >= head_end:
                # What follows a run is the same for all tokens that could begin in it.
                head_end = SIGNED_HEAD.match(text, start).end()
                tail = SIGNED_TAIL.match(text, head_end)
                if tail is not None and not _json_part(text, *tail.span(1)):
                    tail = None
            if tail is None:
                over[kind] = head_end
            elif head_end - start > 3 and _json_part(text, start, head_end):
                over[kind] = tail.end()
                spans.append((kind, start, tail.end()))
        elif (match := PRIVATE.match(text, start)) is not None:
            over[kind] = match.end()
            spans.append((kind, start, match.end()))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``secret_spans`` of ``kind, start, end`` in code points.

    Every whole text is scanned; a null or empty text has no spans. Rows stay as they are,
    repeated ones included, and so do other columns (a column ``secret_spans`` is replaced).
    An empty table stays empty. Memory is bounded by one batch of texts.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton()
        for texts in batches:
            rows = []
            for t in texts:
                found = find_secrets(t.as_py(), automaton) if t.is_valid else ()
                rows.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in found])
            yield pa.array(rows, type=kind)

    # Evaluated once, however often the spans are used above.
    return docs.withColumn("secret_spans", scan.asNondeterministic()(F.col(text)))
