"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item becomes windows of ``size`` consecutive words. The words of a window are
ordered by how rare they are in all documents. A document that contains the window whole has
to contain its rarest word, so that one word is the prefix to join on; where it stands in the
window bounds where the window can stand in the document, and the ends of the document bound
it too. What is left is verified word by word, then byte by byte.

The benchmark is worked through in blocks of a fixed number of windows, so what tasks and
driver hold has a bound however large the benchmark is. Documents are never shuffled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import separators, word_hashes, words
from .work import stored, text_chunks, work_folder

# Bytes between words, after A-Z became a-z.
BETWEEN_WORDS = ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

HITS = "array<struct<start:bigint,size:bigint,window_id:bigint>>"
FOUND = f"struct<n_words:bigint,hits:{HITS}>"
_PAIRS = 1 << 20


def benchmark_windows(items: DataFrame, size: int) -> DataFrame:
    """``item_id, window`` with the words of a window joined by one blank; each pair once."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            data = _LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends, _ = words(data, np.array([0, len(data)]), separators(*BETWEEN_WORDS))
            raw = data.tobytes()
            parts = [raw[s:e].decode() for s, e in zip(starts, ends, strict=True)]
            last = max(len(parts) - size, 0) if parts else -1
            out.append([" ".join(parts[i : i + size]) for i in range(last + 1)])
        return pa.array(out, pa.list_(pa.string()))

    return items.select("item_id", F.explode(cut(F.col("text"))).alias("window")).distinct()


def _count_words(texts: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """How often each word of ``vocabulary`` (sorted hashes) stands in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = separators(*BETWEEN_WORDS)
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                data = _LOWER[data]
                starts, ends, _rows = words(data, offsets, table)
                hashed = word_hashes(data, starts, ends)
                at = np.minimum(np.searchsorted(vocabulary, hashed), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == hashed], minlength=len(vocabulary))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["word", "n"])

    counts = texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


class _Block:
    """Windows of one block, by their rarest word."""

    def __init__(self, ids: list[int], windows: list[str], count) -> None:
        table = separators(*BETWEEN_WORDS)
        data = np.frombuffer("\n".join(windows).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) + 1 for w in windows])
        starts, stops, rows = words(data, np.concatenate(([0], np.append(ends[:-1], len(data)))), table)
        hashed = word_hashes(data, starts, stops)
        vocabulary = np.unique(hashed)
        frequency = np.zeros(len(vocabulary), np.int64)
        for word, n in count(vocabulary).items():
            frequency[word] = n
        # The rarest word first, of equally rare ones the smaller hash, then the first place.
        place = np.searchsorted(vocabulary, hashed)
        row = np.repeat(np.arange(len(windows)), np.diff(rows))
        order = np.lexsort((np.arange(len(hashed)), hashed, frequency[place], row))
        key = order[rows[:-1]]
        by_token = np.argsort(hashed[key], kind="stable")
        self.tokens, self.first = np.unique(hashed[key][by_token], return_index=True)
        self.first = np.append(self.first, len(windows))
        self.shift = (key - rows[:-1])[by_token]
        self.begin, self.size = rows[:-1][by_token], np.diff(rows)[by_token]
        self.hashed = hashed
        self.ids = np.array(ids, np.int64)[by_token]
        self.raw = [windows[i].encode() for i in by_token]

    def hits(self, data, starts, ends, rows):
        """``(row, start, window)`` of every occurrence in a chunk of documents."""
        hashed = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.tokens, hashed), len(self.tokens) - 1)
        spots = np.flatnonzero(self.tokens[at] == hashed)
        many = self.first[at[spots] + 1] - self.first[at[spots]]
        raw, done = None, 0
        reach = np.cumsum(many)
        while done < len(spots):
            # Bounded steps, as one word may be the rarest of many windows.
            stop = max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + _PAIRS)))
            part, n = spots[done:stop], many[done:stop]
            done = stop
            spot = np.repeat(part, n)
            window = np.repeat(self.first[at[part]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            start = spot - self.shift[window]
            row = np.searchsorted(rows, spot, "right") - 1
            fits = (start >= rows[row]) & (start + self.size[window] <= rows[row + 1])
            start, window, row = start[fits], window[fits], row[fits]
            for k in range(int(self.size[window].max(initial=0))):
                short = k >= self.size[window]
                same = short | (
                    hashed[np.minimum(start + k, len(hashed) - 1)]
                    == self.hashed[np.minimum(self.begin[window] + k, len(self.hashed) - 1)]
                )
                start, window, row = start[same], window[same], row[same]
            for s, w, r in zip(start.tolist(), window.tolist(), row.tolist(), strict=True):
                raw = data.tobytes() if raw is None else raw
                found = b" ".join(raw[starts[i] : ends[i]] for i in range(s, s + int(self.size[w])))
                if found == self.raw[w]:
                    yield r, s - int(rows[r]), w


def _find_hits(texts: pa.Array, block: _Block) -> pa.Array:
    table = separators(*BETWEEN_WORDS)
    found: list[list] = [[] for _ in range(len(texts))]
    counts = [np.zeros(0, np.int64)]
    for first, data, offsets in text_chunks(texts):
        data = _LOWER[data]
        starts, ends, rows = words(data, offsets, table)
        counts.append(np.diff(rows))
        for r, s, w in block.hits(data, starts, ends, rows):
            found[first + r].append({"start": s, "size": int(block.size[w]), "window_id": int(block.ids[w])})
    kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64()), ("window_id", pa.int64())]))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(counts)), pa.array(found, kind)], ["n_words", "hits"])


def _hits_of(block: _Block):
    """``FOUND`` of a text; both at once, so that a task needs one Python worker."""

    @F.arrow_udf(FOUND)
    def hits(texts: pa.Array) -> pa.Array:
        return _find_hits(texts, block)

    # Evaluated once, not again for the filter on its result.
    return hits.asNondeterministic()


@F.arrow_udf(T.LongType())
def count_words(texts: pa.Array) -> pa.Array:
    table = separators(*BETWEEN_WORDS)
    counts = [np.zeros(0, np.int64)]
    for _, data, offsets in text_chunks(texts):
        counts.append(np.diff(words(_LOWER[data], offsets, table)[2]))
    return pa.array(np.concatenate(counts))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    block_windows: int = 50_000,
    folder: str | None = None,
) -> DataFrame:
    """Occurrences of benchmark windows in documents.

    ``docs``: ``doc_id, text``; ``items``: ``item_id, text``. Returns ``doc_id, text_hash,
    n_words, n_hit, item_ids, spans``, one row per different ``(doc_id, text)`` with a hit:
    ``n_hit`` words lie in an occurrence, ``spans`` are their ``start, end`` in words,
    ``item_ids`` the distinct items. Documents without a hit have no row. ``text_hash`` is
    ``xxhash64(text)``.

    Words are runs of letters, digits and other characters beyond ASCII, with A-Z in lower
    case. An item shorter than ``size`` words is one window, an item without words or with a
    null text none. Null and empty texts have no words. Items that share a window are all
    reported; repeated items count once, repeated documents give one row. A null ``doc_id``
    is an id like any other. Empty tables give no rows; other columns are ignored.

    One block of ``block_windows`` windows at a time is held by driver and tasks.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    pairs = benchmark_windows(items, size).withColumn("window_id", F.xxhash64("window"))
    pairs = stored(pairs, folder, "windows")
    texts = docs.select("text").where(F.col("text").isNotNull())
    n_windows = pairs.select("window").distinct().count()
    blocks = -(-n_windows // block_windows)
    keys = ("doc_id", "text_hash", "n_words")
    rows = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )
    found = None
    for b in range(blocks):
        block_rows = (
            pairs.where(F.pmod(F.col("window_id"), F.lit(blocks)) == b)
            .select("window_id", "window")
            .distinct()
            .collect()
        )
        if not block_rows:
            continue
        block = _Block(
            [r["window_id"] for r in block_rows],
            [r["window"] for r in block_rows],
            lambda vocabulary: _count_words(texts, vocabulary),
        )
        part = rows.withColumn("found", _hits_of(block)(F.col("text"))).where(F.size("found.hits") > 0)
        part = part.select("doc_id", "text_hash", "found.n_words", "found.hits")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.where("false").select(
            "doc_id", "text_hash", F.lit(0).cast("long").alias("n_words"), F.array().cast(HITS).alias("hits")
        )
    found = stored(found.dropDuplicates(["doc_id", "text_hash", "hits"]), folder, "hits")
    per_doc = found.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"))
    merged = F.aggregate(
        F.array_distinct(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), (h["start"] + h["size"]).alias("end")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"),
            F.greatest(a["to"], s["end"]).alias("to"),
        ),
    )
    named = (
        found.select("doc_id", "text_hash", F.explode("hits.window_id").alias("window_id"))
        .distinct()
        .join(pairs.select("window_id", "item_id").distinct(), "window_id")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )
    # One match per row of either side; null ids match each other.
    left, right = per_doc.alias("l"), named.alias("r")
    same = (F.col("l.text_hash") == F.col("r.text_hash")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
    return left.join(right, same).select(
        "l.doc_id",
        "l.text_hash",
        "l.n_words",
        merged["n"].alias("n_hit"),
        "r.item_ids",
        F.transform("hits", lambda h: F.struct(h["start"].alias("start"), (h["start"] + h["size"]).alias("end"))).alias("spans"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark; other rows and columns stay.

    Rows with null texts stay, and repeated rows are kept or dropped together.
    """
    hit = contamination(docs, items, size).select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    same = (F.xxhash64("text") == F.col("hit_hash")) & F.col("doc_id").eqNullSafe(F.col("hit_id"))
    return docs.join(hit, same, "left_anti")
