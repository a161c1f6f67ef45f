"""Where texts can repeat: minimizers and the windows that share one.

A text is a row of units, words or bytes; a window is ``size`` of them. Every window has an
anchor, the leftmost of its grams of ``gram`` units whose hash is smallest. Equal windows have equal anchors,
so only windows of equal anchors need comparing. The windows of one place of an anchor form a
context, one row, so that there are a few rows per window length and not one per unit.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import gram_hashes, mix, sliding_min, span_hashes, within_rows
from .work import text_chunks

# Text that goes through numpy at once: its arrays, eight bytes a unit, stay in a core's cache.
PIECE_BYTES = 1 << 17
_PLACE = np.uint64((1 << 30) - 1)

# data, offsets -> unit values, first unit of each row
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def window_runs(values: np.ndarray, rows: np.ndarray, size: int, gram: int):
    """``row, start, n, lead, anchor, context`` of the contexts of concatenated rows of units.

    ``start`` is the first unit of the first of ``n`` windows within its row, with ``lead`` units
    before its anchor; ``context`` hashes all units of these windows. Contexts have ``size - gram + 1`` windows at most.
    """
    width = size - gram + 1
    at = within_rows(rows, size)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = gram_hashes(values, gram)
    # The place in the low bits makes the leftmost of equal grams the smallest.
    place = (sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), width) & _PLACE)[at]
    anchor = grams[place.astype(np.int64)]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    start = at[first]
    context = span_hashes(values, start, start + n - 1 + size)
    row = np.searchsorted(rows, start, "right") - 1
    return row, start - rows[row], n, place[first].astype(np.int64) - start, anchor[first], context


def contexts(docs: DataFrame, units: Units, size: int, gram: int) -> DataFrame:
    """``doc_id, text_hash, start, n, lead, anchor, context`` for every row of ``docs`` with a text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(2), PIECE_BYTES):
                row, start, n, lead, anchor, context = window_runs(*units(data, offsets), size, gram)
                take = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(start.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(lead.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(context.view(np.int64)),
                    ],
                    ["doc_id", "text_hash", "start", "n", "lead", "anchor", "context"],
                )

    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, text_hash long, start int, n int, lead int, anchor long, context long")


def window_hashes(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """One hash for the window at each of the places ``at``."""
    return mix(span_hashes(values, at, at + size) + np.uint64(size))
