"""Line deduplication by content-defined chunks of lines.

A rolling hash over the hashes of the last lines decides after which lines a chunk ends, so
boundaries depend on nothing but those lines and fall into step again after an insertion.
Chunks of several lines that occur more than once anywhere are compared byte by byte with
their first occurrence, and all but that one are removed.

Boundaries of one cutting may leave a short passage without a whole chunk inside. Each text is
therefore cut several times more: under each further cutting some lines, by their own hash,
begin a chunk and some end one. A passage whose first line begins a chunk and whose last line
ends one is found whatever stands around it; a chunk repeated under any cutting goes. What goes
has an equal at an earlier place, so one copy of it always stays.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .work import stored, text_chunks, work_folder

# First cutting: the hashes of two lines, combined by this factor, are a multiple of DIVISOR.
WIDTH, FACTOR, DIVISOR = 2, 31, 4
# Further cuttings, 32 at most: two hexadecimal digits of a line's hash each, the first below MARK
# where a chunk begins before the line, the second where one ends after it.
CUTTINGS, MARK = 24, 6
BLANK = " \t\n\r\v\f"

RUN = T.StructType().add("first", "long").add("n", "long")
CHUNK = T.StructType().add("first", "long").add("n", "long").add("digest", "binary")
_CHUNK = pa.struct([("first", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])


def chunk_ends(hashes: np.ndarray, firsts: np.ndarray, cuttings: int) -> np.ndarray:
    """Whether a chunk ends after a line (row), under each cutting (column).

    ``hashes`` are the SHA-256 bytes of the lines of several texts, ``firsts`` the first line of each.
    """
    begins = np.zeros(len(hashes), bool)
    begins[firsts] = True
    number = hashes[:, :4].copy().view(">u4")[:, 0].astype(np.int64)
    last = np.where(begins, 0, np.roll(number, 1))
    ends = np.empty((len(hashes), cuttings + 1), bool)
    ends[:, 0] = (last * FACTOR + number) % DIVISOR == 0
    digits = np.stack((hashes >> 4, hashes & 15), 2).reshape(len(hashes), 64)
    marks = digits[:, : 2 * cuttings] < MARK
    ends[:, 1:] = marks[:, 1::2] | np.roll(marks[:, 0::2], -1, axis=0)
    return ends | np.roll(begins, -1)[:, None]


def multi_line_chunks(texts: list[str], cuttings: int = CUTTINGS) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Text, first line, number of lines and digest of each chunk with two lines or more that are not blank.

    In order of text; a chunk of several cuttings is there once.
    """
    split = [x.split("\n") for x in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    firsts = np.cumsum(sizes) - sizes
    raw = b"".join(hashlib.sha256(line.encode()).digest() for own in split for line in own)
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 32)
    full = np.array([bool(line.strip(BLANK)) for own in split for line in own], bool)
    before = np.concatenate(([0], np.cumsum(full)))
    found, size = [np.zeros(0, np.int64)], len(full) + 1
    for ends in chunk_ends(hashes, firsts, cuttings).T if len(full) else ():
        end = np.flatnonzero(ends) + 1
        begin = np.concatenate(([0], end[:-1]))
        found.append((begin * size + end)[before[end] - before[begin] > 1])
    runs = np.stack(np.divmod(np.unique(np.concatenate(found)), size), 1)
    text = np.searchsorted(firsts, runs[:, 0], "right") - 1
    digests = [hashlib.sha256(raw[32 * a : 32 * b]).digest()[:16] for a, b in runs.tolist()]
    return text, runs[:, 0] - firsts[text], runs[:, 1] - runs[:, 0], digests


def chunk_lists(texts: pa.Array, cuttings: int = CUTTINGS) -> pa.Array:
    """The chunks of each text.

    Lines under all cuttings take many times the bytes of their texts, so a batch goes through in
    pieces of bounded size.
    """
    out = [pa.array([], pa.list_(_CHUNK))]
    for start, _, offsets in text_chunks(texts):
        part = texts.slice(start, len(offsets) - 1).to_pylist()
        text, first, n, digests = multi_line_chunks(part, cuttings)
        offsets = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
        parts = pa.StructArray.from_arrays(
            [pa.array(first), pa.array(n), pa.array(digests, pa.binary())], fields=list(_CHUNK)
        )
        out.append(pa.ListArray.from_arrays(pa.array(offsets), parts))
    return pa.concat_arrays(out)


def _chunks(cuttings: int):
    @F.arrow_udf(T.ArrayType(CHUNK))
    def chunks(texts: pa.Array) -> pa.Array:
        return chunk_lists(texts, cuttings)

    return chunks.asNondeterministic()


def covering(runs: list[dict]) -> list[dict]:
    """As few of ``runs`` as hold every line that any of them holds; no line is in more than two."""
    taken, best, reach = [], None, 0
    for run in sorted(runs, key=lambda r: r["first"]):
        if run["first"] > reach:
            if best is not None and best["first"] + best["n"] > reach:
                taken.append(best)
                reach = best["first"] + best["n"]
            reach = max(reach, run["first"])
        if best is None or run["first"] + run["n"] > best["first"] + best["n"]:
            best = run
    if best is not None and best["first"] + best["n"] > reach:
        taken.append(best)
    return taken


@F.arrow_udf(T.ArrayType(CHUNK))
def _covering(runs: pa.Array) -> pa.Array:
    return pa.array([covering(own.as_py()) for own in runs], pa.list_(_CHUNK))


@F.arrow_udf(T.ArrayType(RUN))
def _joined(runs: pa.Array) -> pa.Array:
    """Sorted runs of lines; those that touch or overlap become one."""
    out = []
    for own in runs.to_pylist():
        whole = []
        for run in own:
            if whole and run["first"] <= whole[-1]["first"] + whole[-1]["n"]:
                last = whole[-1]
                last["n"] = max(last["n"], run["first"] + run["n"] - last["first"])
            else:
                whole.append(run)
        out.append(whole)
    return pa.array(out, pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())])))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _cut(texts: pa.Array, firsts: pa.Array, sizes: pa.Array) -> pa.Array:
    """The named runs of lines of each text."""
    out = []
    for text, first, n in zip(texts.to_pylist(), firsts.to_pylist(), sizes.to_pylist(), strict=True):
        lines = text.split("\n")
        out.append(["\n".join(lines[a : a + b]) for a, b in zip(first, n, strict=True)])
    return pa.array(out, pa.list_(pa.string()))


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, firsts: pa.Array, sizes: pa.Array) -> pa.Array:
    """Each text without the named runs of lines."""
    out = []
    for text, first, n in zip(texts.to_pylist(), firsts.to_pylist(), sizes.to_pylist(), strict=True):
        if not first:
            out.append(text)
            continue
        lines = text.split("\n")
        gone = {i for a, b in zip(first, n, strict=True) for i in range(a, a + b)}
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return pa.array(out, pa.string())


def _same_row(left: str, right: str) -> Column:
    ids = F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
    return (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash")) & ids


def repeated_chunks(docs: DataFrame, folder: str | None = None, cuttings: int = CUTTINGS) -> DataFrame:
    """``doc_id, text_hash, removed``: the maximal runs ``first, n`` of lines to remove from a text.

    Chunks are compared over all documents; the first occurrence by ``doc_id`` (null first),
    then text hash, then place, stays. ``text_hash`` is ``xxhash64(text)``. Rows of the same
    id and text are one document here. Of overlapping repeated chunks only as many are compared
    by their bytes as hold all their lines.
    """
    folder = folder or work_folder(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    chunks = stored(
        rows.select("doc_id", "text_hash", F.explode(_chunks(cuttings)("text")).alias("c")).select(
            "doc_id", "text_hash", "c.*"
        ),
        folder,
        "chunks",
    )
    # Counted before anything is joined: a hot chunk sends one row per task.
    place = F.struct("doc_id", "text_hash", "first")
    n = chunks.count()
    repeated = chunks.groupBy("digest").agg(F.min(place).alias("original"), F.max(place).alias("last"))
    repeated = stored(repeated.where("original <> last").select("digest", "original"), folder, "repeated", n)
    again = chunks.join(repeated, "digest").where(place != F.col("original"))
    cover = again.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "n", "digest")).alias("runs"))
    cover = stored(
        cover.select("doc_id", "text_hash", F.explode(_covering("runs")).alias("c")).select("doc_id", "text_hash", "c.*"),
        folder,
        "cover",
        n,
    )
    # The one chunk of each digest that the others are held against.
    used = cover.select("digest").distinct()
    originals = chunks.join(repeated.join(used, "digest"), "digest").where(place == F.col("original"))
    originals = originals.select(*cover.columns).dropDuplicates(["digest"])
    named = cover.withColumn("is_original", F.lit(False)).unionByName(originals.withColumn("is_original", F.lit(True)))
    per_doc = named.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("first", "n", "digest", "is_original")).alias("runs")
    )
    # Only documents that hold such a chunk send their text on.
    texts = (
        rows.alias("d")
        .join(per_doc.alias("r"), _same_row("d", "r"))
        .select("d.doc_id", "d.text_hash", "runs", _cut("text", F.col("runs.first"), F.col("runs.n")).alias("texts"))
    )
    copies = stored(
        texts.select("doc_id", "text_hash", F.explode(F.arrays_zip("runs", "texts")).alias("c")).select(
            "doc_id", "text_hash", "c.runs.*", F.col("c.texts").alias("bytes")
        ),
        folder,
        "copies",
    )
    originals = copies.where("is_original").select("digest", F.col("bytes").alias("original_bytes")).dropDuplicates(["digest"])
    equal = copies.where("NOT is_original").join(originals, "digest").where(F.col("bytes") == F.col("original_bytes"))
    found = equal.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("first", "n"))).alias("runs"))
    return found.select("doc_id", "text_hash", _joined("runs").alias("removed"))


def dedup_lines(docs: DataFrame, folder: str | None = None, cuttings: int = CUTTINGS) -> DataFrame:
    """``docs`` with repeated multi-line chunks taken out of ``text``; and ``removed``.

    ``removed`` lists the maximal runs ``first, n`` of lines that went, empty where nothing did. What
    is left is joined by line ends; a text that consists of repeated chunks becomes empty,
    its row stays. Null and empty texts, single lines and chunks with fewer than two lines
    that are not blank never change. Rows that repeat both id and text change alike. An empty
    table stays empty; other columns stay (a column ``removed`` is replaced).

    ``cuttings`` is the number of further cuttings of each text, at most 32.
    """
    found = repeated_chunks(docs, folder, cuttings)
    columns = [c for c in docs.columns if c != "removed"]
    runs = F.coalesce(F.col("r.removed"), F.array().cast("array<struct<first:bigint,n:bigint>>"))
    same = (F.xxhash64("d.text") == F.col("r.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    joined = docs.alias("d").join(found.alias("r"), same, "left")
    joined = joined.select(*(F.col(f"d.{c}") for c in columns), runs.alias("removed"))
    text = F.when(F.size("removed") > 0, _without("text", F.col("removed.first"), F.col("removed.n"))).otherwise(F.col("text"))
    return joined.withColumn("text", text)
