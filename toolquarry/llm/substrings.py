"""Substring deduplication by suffix automata of reference shards.

Every sequence of ``size`` words that also starts in a document of a smaller id is removed
where it stands. Contexts (``contexts``) tell which passages can repeat, and where each first
stands; those first places, and nothing else of the corpus, become reference shards of a
bounded number of words. A shard's suffix automaton is sent to the tasks that hold passages
assigned to it, and these passages stream through it for their matching statistics: wherever
``size`` words match a smaller id, the words are removed. A shard that many passages ask for
is handed to several tasks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contexts import PIECE_BYTES, contexts, window_hashes
from .hashing import separators, word_hashes, words
from .work import of_the_rest, passing, stored, text_chunks, text_filter, work_folder

SPACE = ((0x20, 0x20), (0x09, 0x0D))
GRAM = 20
BLOCK = 20_000  # words of one document that go to one shard
SHARD_WORDS = 40_000
TASK_WORDS = 400_000
FLUSH_BYTES = 4 << 20


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = words(data, offsets, separators(*SPACE))
    return word_hashes(data, starts, ends), rows


def split_words(text: str) -> list[bytes]:
    return text.encode().split()


class Automaton:
    """Suffix automaton of several word sequences; a state knows the smallest id it stands in."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.smallest = [-1], [0], [None]

    def add(self, sequence: list, own) -> None:
        follow, link, length, smallest = self.next, self.link, self.length, self.smallest
        last = 0
        for word in sequence:
            there = follow[last].get(word)
            if there is not None:
                if length[there] != length[last] + 1:
                    there = self._split(last, there, word)
                if smallest[there] is None or own < smallest[there]:
                    smallest[there] = own
                last = there
                continue
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            smallest.append(own)
            link.append(0)
            at = last
            while at != -1 and word not in follow[at]:
                follow[at][word] = new
                at = link[at]
            if at != -1:
                there = follow[at][word]
                if length[there] != length[at] + 1:
                    there = self._split(at, there, word)
                link[new] = there
            last = new

    def _split(self, at: int, there: int, word) -> int:
        follow, link, length, smallest = self.next, self.link, self.length, self.smallest
        copy = len(follow)
        follow.append(dict(follow[there]))
        length.append(length[at] + 1)
        link.append(link[there])
        smallest.append(smallest[there])
        link[there] = copy
        while at != -1 and follow[at].get(word) == there:
            follow[at][word] = copy
            at = link[at]
        return copy

    def finish(self) -> None:
        """Hand the smallest ids on to the states of shorter suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up, own = self.link[state], self.smallest[state]
            if up > 0 and (self.smallest[up] is None or own < self.smallest[up]):
                self.smallest[up] = own

    def matches(self, sequence: list, size: int, own) -> list[int]:
        """Ends (exclusive) of the windows of ``size`` words that stand in a smaller id."""
        follow, link, length, smallest = self.next, self.link, self.length, self.smallest
        state = matched = 0
        out = []
        for i, word in enumerate(sequence, 1):
            to = follow[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = follow[state].get(word)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched >= size:
                while length[link[state]] >= size:
                    state = link[state]
                matched = size
                if smallest[state] < own:
                    out.append(i)
        return out


def _spans(ends: list[int], size: int) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for end in ends:
        if spans and end - size <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([end - size, end])
    return [tuple(s) for s in spans]


def _window_rows(size: int):
    """Texts and runs ``start, n, anchor, context`` to ``anchor, context, i, window``, a piece of the batch at a time."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            columns = [lists.values.field(x).to_numpy() for x in ("start", "n", "anchor", "context")]
            for first, data, offsets in text_chunks(batch.column(0), PIECE_BYTES):
                values, at = word_units(data, offsets)
                own = slice(ends[first], ends[first + len(at) - 1])
                start, n, anchor, context = (c[own] for c in columns)
                begin = np.repeat(at[:-1], np.diff(ends[first : first + len(at)])) + start
                run = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
                window = window_hashes(values, begin[run] + i, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[run]), pa.array(context[run]), pa.array(i.astype(np.int32)), pa.array(window.view(np.int64))],
                    ["anchor", "context", "i", "window"],
                )

    return hashes


def _mixed_windows(rows: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``anchor, context, i, window`` for contexts whose anchor has several of them.

    ``rows``: one place ``doc_id, text_hash, start, n`` of each context.
    """
    wanted = rows.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "anchor", "context"))).alias("runs")
    )
    joined = texts.join(wanted, ["doc_id", "text_hash"]).select("text", "runs")

    return joined.mapInArrow(_window_rows(size), "anchor long, context long, i int, window long")


def _assigned(shared: DataFrame, texts: DataFrame, size: int, folder: str) -> DataFrame:
    """Windows that may stand in a smaller id, and the first place they are to be held against.

    ``doc_id, text_hash, start, n, ref_id, ref_hash, ref_start``. ``shared``: contexts whose
    anchor stands in several documents, with the least of those and whether it is ``mixed``.
    """
    place = F.struct("doc_id", "text_hash", "start")
    # One context: the anchor's first document has these very words.
    plain = shared.where("NOT mixed")
    first = plain.where("doc_id = low").groupBy("anchor").agg(F.min(place).alias("ref"))
    plain = plain.where("doc_id > low").join(first, "anchor").select("doc_id", "text_hash", "start", "n", "ref")
    # Several contexts: windows are told apart, those of one place per context.
    mixed = shared.where("mixed")
    own = mixed.groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "text_hash", "start", "n")).alias("own"))
    own = stored(own.select("anchor", "context", "own.*"), folder, "mixed")
    windows = stored(_mixed_windows(own, texts, size), folder, "windows")
    placed = windows.join(own, ["anchor", "context"]).withColumn("start", F.col("start") + F.col("i"))
    least = placed.groupBy("window").agg(F.min(place).alias("ref"))
    named = placed.select("anchor", "context", "i", "window").join(least, "window")
    # Windows in step with the same first document are one run again.
    named = named.groupBy("anchor", "context", "ref.doc_id", "ref.text_hash", F.expr("ref.start - i").alias("shift")).agg(
        F.sort_array(F.collect_list("i")).alias("at")
    )
    runs = named.select(
        "anchor",
        "context",
        F.struct("doc_id", "text_hash", (F.col("shift") + F.col("at")[0]).alias("start")).alias("ref"),
        F.col("at")[0].alias("i"),
        (F.element_at("at", -1) - F.col("at")[0] + 1).alias("n"),
    )
    mixed = (
        mixed.drop("n")
        .join(runs, ["anchor", "context"])
        .where("ref.doc_id < doc_id")
        .select("doc_id", "text_hash", (F.col("start") + F.col("i")).alias("start"), "n", "ref")
    )
    return plain.unionByName(mixed).select(
        "doc_id",
        "text_hash",
        "start",
        F.col("n").cast("long").alias("n"),
        F.col("ref.doc_id").alias("ref_id"),
        F.col("ref.text_hash").alias("ref_hash"),
        F.col("ref.start").alias("ref_start"),
    )


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def _cut_passages(size: int):
    """Texts and their orders ``shard, task, is_query, start, n`` to word sequences."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "task", "is_query", "doc_id", "text_hash", "start", "passage"]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), None, pa.int64(), pa.int64(), pa.binary()]
        out, held = [], 0
        for batch in batches:
            kinds[3] = batch.column(0).type
            for r in range(batch.num_rows):
                doc_id, text_hash, text, orders = (c[r].as_py() for c in batch.columns)
                text = split_words(text)
                runs: list[list] = []
                for o in orders:
                    key = (o["shard"], o["task"], o["is_query"])
                    end = o["start"] + o["n"] - 1 + size
                    if runs and runs[-1][0] == key and o["start"] <= runs[-1][2] - size + 1:
                        runs[-1][2] = max(runs[-1][2], end)
                    else:
                        runs.append([key, o["start"], end])
                for key, start, end in runs:
                    passage = b" ".join(text[start:end])
                    out.append((*key, doc_id, text_hash, start, passage))
                    held += len(passage) + 64
                if held > FLUSH_BYTES:
                    yield _batch(out, names, kinds)
                    out, held = [], 0
        if out:
            yield _batch(out, names, kinds)

    return cut


def _match_shards(size: int):
    """Rows sorted by ``shard, task, is_query`` to ``doc_id, text_hash, start, end``."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automaton, ready = None, None, False
        for batch in batches:
            out = ([], [], [], [])
            for x in batch.to_pylist():
                if (x["shard"], x["task"]) != key:
                    key, automaton, ready = (x["shard"], x["task"]), Automaton(), False
                passage = x["passage"].split(b" ")
                if not x["is_query"]:
                    automaton.add(passage, x["doc_id"])
                    continue
                if not ready:
                    automaton.finish()
                    ready = True
                for a, b in _spans(automaton.matches(passage, size, x["doc_id"]), size):
                    for column, value in zip(out, (x["doc_id"], x["text_hash"], x["start"] + a, x["start"] + b), strict=True):
                        column.append(value)
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "text_hash", "start", "end"]
            )

    return match


def repeated_passages(docs: DataFrame, size: int = 50, folder: str | None = None) -> DataFrame:
    """``doc_id, text_hash, spans``: the maximal spans ``start, end`` (words) to remove.

    A span is a union of windows of ``size`` words whose sequence also starts in a document
    with a smaller id. Documents without one have no row. ``text_hash`` is ``xxhash64(text)``.

    Words are runs of bytes other than blanks and 0x09-0x0D. Null and empty texts and texts of
    fewer than ``size`` words have no windows, and rows with a null ``doc_id`` take no part.
    Rows that repeat both id and text are one document; different texts of one id are equally
    first. An empty table gives no rows; other columns are ignored.

    Which place a window is compared with is looked up by 64-bit hashes; that it is equal is
    decided on its words. Automata have ``SHARD_WORDS`` words on average.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    kept = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = stored(contexts(kept, word_units, size, GRAM).drop("lead"), folder, "contexts")
    # Only what shares an anchor with another document is looked at again.
    anchors = rows.groupBy("anchor").agg(
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
        F.min("context").alias("least"),
        F.max("context").alias("most"),
    )
    anchors = anchors.where("low < high").select("anchor", "low", (F.col("least") < F.col("most")).alias("mixed"))
    shared = stored(rows.join(anchors, "anchor"), folder, "shared")
    some = shared.select("doc_id", "text_hash").distinct()
    texts = passing(kept, text_filter(some)).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    texts = stored(texts.join(some, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"]), folder, "texts")
    asked = stored(_assigned(shared, texts, size, folder), folder, "asked")

    block = F.floor(F.col("ref_start") / BLOCK)
    held = asked.select("ref_id", "ref_hash", "ref_start", "n").distinct()
    shards = max(1, int(held.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS)
    shard = F.pmod(F.xxhash64("ref_id", "ref_hash", block), F.lit(shards))
    asked = asked.withColumn("shard", shard)
    load = asked.groupBy("shard").agg(F.ceil(F.sum("n") / TASK_WORDS).alias("tasks"))
    asked = asked.join(load, "shard").withColumn("task", F.pmod(F.xxhash64("doc_id", "text_hash"), F.col("tasks")))
    held = held.withColumn("shard", shard).join(load, "shard")
    held = held.withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)))
    orders = held.select(
        F.col("ref_id").alias("doc_id"), F.col("ref_hash").alias("text_hash"), "shard", "task",
        F.lit(False).alias("is_query"), F.col("ref_start").alias("start"), "n",
    ).unionByName(asked.select("doc_id", "text_hash", "shard", "task", F.lit(True).alias("is_query"), "start", "n"))
    orders = orders.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("shard", "task", "is_query", "start", "n"))).alias("orders")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    passages = texts.join(orders, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "orders")
    passages = passages.mapInArrow(
        _cut_passages(size),
        f"shard long, task long, is_query boolean, doc_id {kind}, text_hash long, start long, passage binary",
    )
    found = (
        passages.repartition("shard", "task")
        .sortWithinPartitions("shard", "task", "is_query")
        .mapInArrow(_match_shards(size), f"doc_id {kind}, text_hash long, start long, end long")
    )
    found = stored(found, folder, "found")
    return found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )


def _remove(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        parts = split_words(text) if text else []
        n = len(parts)
        for s in reversed(_union(own or [])):
            del parts[s[0] : s[1]]
        out.append((n, n - len(parts), b" ".join(parts).decode()))
    names = ["n_words", "n_removed", "text"]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.StructArray.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names)


def _union(spans: list[dict]) -> list[list[int]]:
    out: list[list[int]] = []
    for s in spans:
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return out


def remove_passages(docs: DataFrame, size: int = 50, folder: str | None = None) -> DataFrame:
    """``docs`` with ``deduplicated``: ``n_words, n_removed, text``.

    ``text`` is what is left, words joined by one blank; see ``repeated_passages``. All rows
    and columns stay (a column ``deduplicated`` is replaced); a null text has no words.
    """
    folder = folder or work_folder(docs.sparkSession)
    found = stored(repeated_passages(docs, size, folder), folder, "spans")
    kind = "struct<n_words:bigint,n_removed:bigint,text:string>"
    remove = F.arrow_udf(_remove, kind)
    columns = [c for c in docs.columns if c != "deduplicated"]
    same = (F.xxhash64("d.text") == F.col("f.text_hash")) & (F.col("d.doc_id") == F.col("f.doc_id"))
    test = text_filter(found)
    joined = passing(docs.select(*columns), test).alias("d").join(found.alias("f"), same, "left")
    joined = joined.select(*(F.col(f"d.{c}") for c in columns), remove("d.text", "f.spans").alias("deduplicated"))
    rest = docs.select(*columns).withColumn("deduplicated", of_the_rest(_remove, kind, test))
    return joined.unionByName(rest.where(F.col("deduplicated").isNotNull()))
