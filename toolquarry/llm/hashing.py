"""Words, rolling hashes and minimizers over many texts at once, in numpy.

All hashes are polynomials modulo 2**64 over odd bases, taken from prefix sums and then
mixed, so that any substring costs one subtraction.
"""

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_OTHER = 0xD6E8FEB86659FD93
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table ``byte -> is a separator``."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for ``i < n`` at least; kept up to a million entries."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if size <= (1 << 21):
            _powers[base] = table
    return table


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair."""
    n = len(values) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum(values * _power_table(base, n)[: n - 1], dtype=np.uint64, out=sums[1:])
    inverse = _power_table(pow(base, -1, 1 << 64), n)
    hashed = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashed + (ends - starts).astype(np.uint64) * np.uint64(_OTHER))


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first word of each row)`` of the words of concatenated rows."""
    n = len(data)
    inside = ~table[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = True
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1:] = True
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``n`` values from each position on; no rows are told apart here."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    # as span_hashes gives them, from slices instead of gathers
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power_table(_OTHER, len(sums))[: len(values)], dtype=np.uint64, out=sums[1:])
    inverse = _power_table(pow(_OTHER, -1, 1 << 64), len(sums))
    hashed = (sums[n:] - sums[:-n]) * inverse[: len(values) - n + 1]
    return mix(hashed + np.uint64(n * _OTHER & 0xFFFFFFFFFFFFFFFF))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each position on."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    padded = np.full(-(-len(values) // width) * width, NONE, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def within_rows(rows: np.ndarray, n: int) -> np.ndarray:
    """Positions from which ``n`` units stay in one row; ``rows``: first unit of each row."""
    total = int(rows[-1])
    last = np.repeat(rows[1:], np.diff(rows))
    return np.flatnonzero(np.arange(total) + n <= last)
