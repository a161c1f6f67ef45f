"""Packing documents into token sequences by shortest-pack-first over the length histogram.

Documents become tokens, and pieces of ``max_tokens`` at most; only the last piece of a
document is shorter. The histogram of piece lengths has ``max_tokens`` entries, however large
the corpus. Lengths are placed from the longest on, each into the emptiest pack that still
takes it, for whole counts of equal packs at a time. The patterns that come out are joined
back to the pieces by their rank within their length. Every task numbers its own pieces of
each length, so ranks need no sort and no length, however frequent, meets in one task.
"""

import base64
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .work import stored, work_folder

END_ID = 0
_FLUSH_BYTES = 4 << 20


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def token_encoder(tokenizer_json: str):
    """Encoder of a byte-level BPE tokenizer file, ``text -> uint32 array``.

    The file's vocabulary lists tokens in the order of their merges, so its ids are ranks
    and a rank encoder gives the ids of the ``tokenizers`` library at several times its
    speed; the tests hold both against each other.
    """
    import public_tokenizers
    import tiktoken

    with open(tokenizer_json, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special
    }
    encoder = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    return lambda text: encoder.encode_to_numpy(text, allowed_special="all")


def token_pieces(docs: DataFrame, tokenizer_json: str, max_tokens: int) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids, part, nth``: the tokens of every whole text.

    ``ids`` holds little-endian unsigned 32-bit ids, with ``END_ID`` after each document.
    ``nth`` numbers the pieces of one length within the task ``part``.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("part", T.LongType()),
            T.StructField("nth", T.LongType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(tokenizer_json)
        part = TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        rows, size, names = [], 0, None

        def flush():
            columns = list(zip(*rows, strict=True))
            ids = columns[0] if isinstance(columns[0], pa.Array) else pa.array(columns[0], names)
            others = [pa.array(c, pa.int64()) for c in columns[1:4]]
            last = [pa.array([part] * len(rows), pa.int64()), pa.array(columns[5], pa.int64())]
            return pa.RecordBatch.from_arrays(
                [ids, *others, pa.array(columns[4], pa.binary()), *last],
                ["doc_id", "start", "length", "doc_tokens", "ids", "part", "nth"],
            )

        for batch in batches:
            names = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") if text.is_valid else np.zeros(0, np.uint32)
                total = len(ids) + 1
                data = np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes()
                for start in range(0, total, max_tokens):
                    n = min(max_tokens, total - start)
                    rows.append((doc_id, start, n, total, data[4 * start : 4 * (start + n)], int(seen[n])))
                    seen[n] += 1
                    size += 4 * n + 64
                    if size > _FLUSH_BYTES:
                        yield flush()
                        rows.clear()
                        size = 0
        if rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack_patterns(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns ``(packs, [(length, times), ...])``, lengths falling, from a histogram."""
    open_packs: dict[int, list[tuple[int, tuple]]] = {}  # space left -> (packs, pattern)
    space = max_tokens

    def put(left: int, packs: int, pattern: tuple) -> None:
        open_packs.setdefault(left, []).append((packs, pattern))

    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count:
            left = max((s for s in open_packs if s >= length), default=None)
            if left is None:
                # New packs, filled with this length as far as it goes.
                times = space // length
                packs = max(count // times, 1)
                times = min(times, count)
                put(space - times * length, packs, ((length, times),))
                count -= packs * times
                continue
            packs, pattern = open_packs[left].pop()
            if not open_packs[left]:
                del open_packs[left]
            times = min(left // length, max(count // packs, 1))
            used = min(packs, count // times)
            put(left - times * length, used, (*pattern, (length, times)))
            if packs > used:
                put(left, packs - used, pattern)
            count -= used * times
    return [(packs, list(p)) for left in sorted(open_packs) for packs, p in open_packs[left]]


def slot_table(patterns: list[tuple[int, list[tuple[int, int]]]], max_tokens: int) -> dict[str, np.ndarray]:
    """Where each rank of each length goes.

    One entry per pattern and length, ordered by ``length`` and ``first`` rank; rank ``r``
    of an entry is slot ``(r - first) % times`` of sequence ``base + (r - first) // times``.
    """
    entries, base = [], 0
    for packs, pattern in patterns:
        offset = 0
        for length, times in pattern:
            entries.append((length, base, times, offset, packs * times))
            offset += length * times
        base += packs
    entries.sort(key=lambda e: e[:2])
    table = np.array(entries, np.int64).reshape(-1, 5)
    counts = table[:, 4]
    total = np.cumsum(counts) - counts  # ranks of all shorter lengths and earlier entries
    lengths = table[:, 0]
    begin = np.searchsorted(lengths, np.arange(max_tokens + 2))
    before = np.append(total, counts.sum())[begin]
    return {"before": before, "place": total, "base": table[:, 1], "times": table[:, 2], "offset": table[:, 3]}


def pack(
    docs: DataFrame, tokenizer_json: str, max_tokens: int = 1024, folder: str | None = None
) -> DataFrame:
    """Pack ``doc_id, text`` into sequences of ``max_tokens`` at most.

    Returns one row per piece: ``doc_id, start`` (tokens of its document before it),
    ``length, doc_tokens, ids`` (little-endian unsigned 32-bit), ``sequence_id, offset``
    (place in its sequence, without gaps from 0).

    A null or empty text is one token, the end id. Null ids, ties and repeated rows are
    documents of their own: nothing is joined by id. A text longer than a sequence is cut
    every ``max_tokens``. An empty table gives no pieces; other columns are ignored.
    The driver holds the histogram, of ``max_tokens`` entries, and the patterns from it,
    of which there are a few per length.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    pieces = stored(token_pieces(docs, tokenizer_json, max_tokens), folder, "pieces")
    per_part = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), folder, "per_part")
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(pack_patterns(histogram, max_tokens), max_tokens)
    before = per_part.alias("b").select(
        "length",
        "part",
        F.expr("coalesce(sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("first"),
    )

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = slots["before"][n] + r
        entry = np.searchsorted(slots["place"], at, "right") - 1
        nth = at - slots["place"][entry]
        sequence, slot = np.divmod(nth, slots["times"][entry])
        return pa.StructArray.from_arrays(
            [pa.array(slots["base"][entry] + sequence), pa.array(slots["offset"][entry] + slot * n)],
            ["sequence_id", "offset"],
        )

    return (
        pieces.join(before, ["length", "part"])
        .withColumn("place", place(F.col("length"), F.col("first") + F.col("nth")))
        .select("doc_id", "start", "length", "doc_tokens", "ids", "place.sequence_id", "place.offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence of ``pack``: ``sequence_id, n_tokens, ids, pieces``.

    A sequence has ``max_tokens`` pieces at most, so its group is bounded.
    """
    piece = F.struct("offset", "doc_id", "start", "length", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return grouped.select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.aggregate("p", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"),
    )
