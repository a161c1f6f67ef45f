"""Suffix-array deduplication by a difference-cover algorithm over shards.

Every string of ``size`` bytes that starts anywhere else too is removed where it stands.
Contexts (``contexts``) tell which passages can repeat; of all places of a passage two go on,
so a passage of a million copies costs as much as one of two. Both places are dealt to the
same shard, of a bounded number of bytes. A shard's suffix array is built by the
difference cover modulo 3: the suffixes at places 1 and 2 modulo 3 are sorted by triples, their
names are sorted recursively, the remaining suffixes are sorted by one byte and a name, and
both orders are merged. Neighbours in the array that agree in ``size`` bytes are repeats, and
only what they certify is removed, at every place of the passage.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contexts import contexts
from .hashing import mix, span_hashes
from .work import of_the_rest, passing, stored, text_chunks, text_filter, work_folder

GRAM = 64
BLOCK = 1 << 16  # bytes of one document that go to one shard
SHARD_BYTES = 1 << 18
UNIT = 16  # windows that are looked up together where contexts differ
FLUSH_BYTES = 4 << 20
_SHORT = 21  # bits of a name that packs three to a word


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data.astype(np.uint64) + np.uint64(1), offsets


def _packed(columns: list[np.ndarray]) -> np.ndarray:
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = (key << _SHORT) | c
    return key


def _order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by several columns, and where a row differs from its predecessor."""
    if max(int(c.max(initial=0)) for c in columns).bit_length() <= _SHORT and len(columns) <= 3:
        key = _packed(columns)
        order = np.argsort(key)
        key = key[order]
        return order, key[1:] != key[:-1]
    order = np.lexsort(columns[::-1])
    new = np.zeros(max(len(order) - 1, 0), bool)
    for c in columns:
        new |= c[order][1:] != c[order][:-1]
    return order, new


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of positive integers, by the difference cover {1, 2} modulo 3."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.concatenate((symbols.astype(np.int32), np.zeros(3, np.int32)))
    # With n = 1 modulo 3 an empty triple ends the first half, so the halves never run together.
    ones = np.arange(1, n + (n % 3 == 1), 3, dtype=np.int32)
    twos = np.arange(2, n, 3, dtype=np.int32)
    sample = np.concatenate((ones, twos))
    ahead = lambda k: np.concatenate((s[1 + k :: 3][: len(ones)], s[2 + k :: 3][: len(twos)]))
    order, new = _order([ahead(0), ahead(1), ahead(2)])
    names = np.empty(len(sample), np.int32)
    names[order] = np.concatenate(([1], 1 + np.cumsum(new)))
    if len(new) and not new.all():
        order = suffix_array(names)
    sample = sample[order]
    rank = np.zeros(n + 3, np.int32)
    rank[sample] = np.arange(1, len(sample) + 1)
    rest = np.arange(0, n, 3, dtype=np.int32)
    rest = rest[_order([s[0:n:3], rank[1 : n + 1 : 3]])[0]]
    sample = sample[sample < n]
    # Merge: how many samples of either kind stand before each of the rest.
    first, second = sample[sample % 3 == 1], sample[sample % 3 == 2]
    before = _smaller([s[first], rank[first + 1]], [s[rest], rank[rest + 1]])
    before += _smaller(
        [s[second], s[second + 1], rank[second + 2]], [s[rest], s[rest + 1], rank[rest + 2]]
    )
    out = np.empty(n, np.int64)
    place = before + np.arange(len(rest))
    out[place] = rest
    free = np.ones(n, bool)
    free[place] = False
    out[free] = sample
    return out


def _smaller(sorted_rows: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """How many of ``sorted_rows`` come before each of ``rows``; both are sorted, none tie."""
    n = len(sorted_rows[0])
    if len(rows) <= 3 and max(int(c.max(initial=0)) for c in (*sorted_rows, *rows)).bit_length() <= _SHORT:
        return np.searchsorted(_packed(sorted_rows), _packed(rows))
    both = [np.concatenate(c) for c in zip(sorted_rows, rows, strict=True)]
    order, _ = _order(both)
    own = order >= n
    counts = np.cumsum(~own)[own]
    return counts


def repeated_starts(passages: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each passage in all of them together, and where in these a window starts that occurs twice.

    Windows do not cross passages.
    """
    data = np.frombuffer(b"".join(passages), np.uint8)
    lengths = np.array([len(p) for p in passages], np.int64)
    begin = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - size + 1, 0)
    row, i = _counted(windows)
    valid = np.zeros(len(data), bool)
    valid[begin[row] + i] = True
    order = suffix_array(data.astype(np.int32) + 1)
    order = order[valid[order]]
    again = np.zeros(len(data), bool)
    if len(order) > 1:
        view = np.lib.stride_tricks.sliding_window_view(data, size)
        for a in range(0, len(order) - 1, 4096):
            part = order[a : a + 4097]
            text = view[part]
            equal = np.flatnonzero((text[1:] == text[:-1]).all(axis=1))
            again[part[equal]] = True
            again[part[equal + 1]] = True
    return begin, again


def _at(side: str, shift: Column) -> Column:
    """The place ``doc_id, text_hash, start`` of a struct column, moved by ``shift``."""
    return F.struct(f"{side}.doc_id", f"{side}.text_hash", (F.col(f"{side}.start") + shift).alias("start"))


def _same_row(left: str, right: str) -> Column:
    ids = F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
    return (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash")) & ids


def _hash_parts(rows: DataFrame, texts: DataFrame, size: int, split, keys: tuple[str, str]) -> DataFrame:
    """``*keys, i, n, part, core``: parts of runs of windows, as ``split`` cuts and hashes them.

    ``rows``: ``doc_id, text_hash, start, n, lead, *keys``.
    """
    run = ("start", "n", "lead", *keys)
    wanted = rows.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct(*run))).alias("runs"))
    joined = texts.alias("t").join(wanted.alias("w"), _same_row("t", "w")).select("text", "runs")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            columns = [lists.values.field(name).to_numpy(zero_copy_only=False) for name in run]
            for first, data, offsets in text_chunks(batch.column(0)):
                values, at = byte_units(data, offsets)
                own = slice(ends[first], ends[first + len(at) - 1])
                begin = np.repeat(at[:-1], np.diff(ends[first : first + len(at)])) + columns[0][own]
                row, i, n, part, core = split(values, begin, columns[1][own], columns[2][own], size)
                named = [c[own][row] for c in columns[3:]]
                out = [*named, i, n, part.view(np.int64), core.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int64, copy=False)) for c in out], [*keys, "i", "n", "part", "core"]
                )

    return joined.mapInArrow(hashes, ", ".join(f"{name} long" for name in (*keys, "i", "n", "part", "core")))


def _counted(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts ``n`` the row of each and its number within the row."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def _units(values, begin, n, lead, size: int) -> tuple[np.ndarray, ...]:
    """Units of ``UNIT`` windows, cut in step with the anchor, so that equal ones meet.

    ``lead`` is the number of bytes of the first window before its anchor. ``part`` hashes all
    bytes of a unit, ``core`` those that each window of a whole unit has.
    """
    row, k = _counted(lead // UNIT - (lead - n + 1) // UNIT + 1)
    lead, n = lead[row], n[row]
    unit = lead // UNIT - k
    first = np.maximum(lead - (unit * UNIT + UNIT - 1), 0)
    count = np.minimum(n - 1, lead - unit * UNIT) - first + 1
    start = begin[row] + first
    part = span_hashes(values, start, start + count - 1 + size) + (lead - first).astype(np.uint64)
    inner = begin[row] + lead - unit * UNIT
    core = span_hashes(values, inner, inner + size - UNIT + 1) + unit.astype(np.uint64)
    return row, first, count, mix(part), mix(core)


def _single_windows(values, begin, n, _lead, size: int) -> tuple[np.ndarray, ...]:
    row, i = _counted(n)
    part = mix(span_hashes(values, begin[row] + i, begin[row] + i + size) + np.uint64(size))
    return row, i, np.ones(len(i), np.int64), part, part


def _runs_across(mixed: DataFrame, texts: DataFrame, size: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Runs of windows that differing contexts of one anchor share.

    ``mixed``: ``anchor, context, n, lead, one, two``, with two places where there are. Returns
    units ``anchor, context, i, core, part`` of contexts with a single place, and the runs in
    them, ``core, part, k, n, one, two``, each once however many contexts hold the unit. Windows
    are looked up by units; only units that agree in their core and not in all go on by window.
    """
    units = _hash_parts(mixed.select("one.*", "n", "lead", "anchor", "context"), texts, size, _units, ("anchor", "context"))
    units = stored(units, folder, "units")
    placed = units.join(mixed.select("anchor", "context", "one", "two"), ["anchor", "context"])
    different = placed.groupBy("core", "part").agg(
        F.min(_at("one", F.col("i"))).alias("one"),
        F.max(_at("two", F.col("i"))).alias("two"),
        F.first("n").alias("n"),
        F.max(F.col("one") == F.col("two")).alias("single"),
    )
    different = stored(different, folder, "different_units")
    whole = different.where("one <> two AND single")
    # A core of several units, one of which has a single place.
    open_cores = different.groupBy("core").agg(
        F.count("*").alias("units"), F.min(F.col("one") != F.col("two")).alias("settled")
    )
    open_cores = open_cores.where("units > 1 AND NOT settled").select("core")
    opened = different.join(open_cores, "core").select("core", "part", "n", "one", "two")
    opened = stored(opened, folder, "opened").withColumnRenamed("core", "unit_core").withColumnRenamed("part", "unit")
    windows = _hash_parts(opened.select("one.*", "n", F.lit(0).alias("lead"), "unit_core", "unit"), texts, size, _single_windows, ("unit_core", "unit"))
    windows = stored(windows.select("unit_core", "unit", "i", F.col("part").alias("window")), folder, "windows")
    windows = windows.join(opened.select("unit_core", "unit", "one", "two"), ["unit_core", "unit"])
    ends = windows.groupBy("window").agg(
        F.min(_at("one", F.col("i"))).alias("low"), F.max(_at("two", F.col("i"))).alias("high")
    )
    found = windows.where("one = two").select("unit_core", "unit", "i", "window").join(ends.where("low <> high"), "window")
    # Windows that move in step on both sides are one run.
    found = found.select("unit_core", "unit", "i", _at("low", -F.col("i")).alias("one"), _at("high", -F.col("i")).alias("two"))
    pair = ("unit_core", "unit", "one", "two")
    island = F.col("i") - F.row_number().over(Window.partitionBy(*pair).orderBy("i"))
    found = found.withColumn("island", island).groupBy(*pair, "island").agg(F.min("i").alias("k"), F.count("*").alias("n"))
    found = found.select(
        F.col("unit_core").alias("core"), F.col("unit").alias("part"), "k", "n", _at("one", F.col("k")).alias("one"), _at("two", F.col("k")).alias("two")
    )
    whole = whole.select("core", "part", F.lit(0).cast("long").alias("k"), "n", "one", "two")
    single = mixed.where("one = two").select("anchor", "context")
    return units.drop("n").join(single, ["anchor", "context"]), whole.unionByName(found)


def _orders(rows: DataFrame, texts: DataFrame, size: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """What to cut from which text: ``doc_id, text_hash, shard, start, n, run``; and the units of ``_runs_across``.

    ``run`` names the windows to certify, ``anchor, context`` or, if ``across``, ``core, part`` of
    a unit, and the first window ``k`` in it; null only bears witness.
    """
    place = F.struct("doc_id", "text_hash", "start")
    found = rows.groupBy("anchor", "context").agg(
        F.min(place).alias("one"), F.max(place).alias("two"), F.first("n").alias("n"), F.first("lead").alias("lead")
    )
    found = stored(found, folder, "distinct")
    alone = F.col("one") == F.col("two")
    open_anchors = found.groupBy("anchor").agg(F.count("*").alias("contexts"), F.max(alone).alias("open"))
    open_anchors = open_anchors.where("contexts > 1 AND open").select("anchor")
    mixed = stored(found.join(open_anchors, "anchor"), folder, "mixed")
    units, runs = _runs_across(mixed, texts, size, folder)
    # A context with two places is held against itself, in step with its neighbours.
    pairs = found.where(~alone).select(
        F.col("anchor").alias("key"), F.col("context").alias("part"), F.lit(0).cast("long").alias("k"),
        F.col("n").cast("long").alias("n"), "one", "two", F.lit(False).alias("across"),
    )
    runs = runs.select(
        F.col("core").alias("key"), "part", F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"),
        "one", "two", F.lit(True).alias("across"),
    )
    pairs = stored(pairs.unionByName(runs), folder, "pairs")
    shards = max(1, int(pairs.agg(F.sum("n")).first()[0] or 0) // SHARD_BYTES)
    block = F.floor(F.col("one.start") / BLOCK)
    pairs = pairs.withColumn("shard", F.pmod(F.xxhash64("one.doc_id", "one.text_hash", block), F.lit(shards)))
    run = F.struct("key", "part", "k", "across")
    none = F.lit(None).cast("struct<key:bigint,part:bigint,k:bigint,across:boolean>")
    orders = pairs.select("one.*", "shard", "n", run.alias("run")).unionByName(
        pairs.select("two.*", "shard", "n", none.alias("run"))
    )
    return orders, units


_NAMES = ("key", "part", "k", "across")
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "n", *_NAMES[:3])] + [("across", pa.bool_())])


def _cut_passages(size: int):
    """Texts and their sorted orders to passages, each with the runs to certify in it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            orders, doc = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            if not len(doc):
                continue
            shard, start, n = (orders.field(x).to_numpy(zero_copy_only=False) for x in ("shard", "start", "n"))
            end = start + n - 1 + size
            # Orders of a text and shard whose windows touch or overlap are one passage.
            group = np.concatenate(([0], np.cumsum((doc[1:] != doc[:-1]) | (shard[1:] != shard[:-1]))))
            reach = np.maximum.accumulate(end + group * (end.max() + 1)) - group * (end.max() + 1)
            new = np.concatenate(([True], (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - size + 1)))
            first = np.flatnonzero(new)
            begin, stop = start[first], reach[np.append(first[1:], len(doc)) - 1]
            passage = np.cumsum(new) - 1
            run = orders.field("run")
            asked = np.flatnonzero(run.is_valid().to_numpy(zero_copy_only=False))
            columns = [pa.array(start[asked] - begin[passage[asked]]), pa.array(n[asked])]
            runs = pa.StructArray.from_arrays(columns + [run.field(x).take(pa.array(asked)) for x in _NAMES], fields=list(_RUN))
            at = np.searchsorted(passage[asked], np.arange(len(first) + 1))
            held = np.cumsum(stop - begin + 48 * np.diff(at))
            texts, number, data = batch.column(0), -1, b""
            a = 0
            while a < len(first):
                b = max(a + 1, int(np.searchsorted(held, (held[a - 1] if a else 0) + FLUSH_BYTES, "right")))
                cuts = []
                for d, x, y in zip(doc[first[a:b]].tolist(), begin[a:b].tolist(), stop[a:b].tolist(), strict=True):
                    if d != number:
                        number, data = d, texts[d].as_py().encode()
                    cuts.append(data[x:y])
                own = pa.ListArray.from_arrays(
                    pa.array((at[a : b + 1] - at[a]).astype(np.int32)), runs.slice(at[a], at[b] - at[a])
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[first[a:b]]), pa.array(cuts, pa.binary()), own], ["shard", "passage", "runs"]
                )
                a = b

    return cut


def _certify(size: int):
    """Passages, sorted by shard, to the runs of windows that occur twice in their shard."""

    def certified(passages: list[bytes], counts: list[np.ndarray], runs: list[pa.Array]) -> pa.RecordBatch:
        begin, again = repeated_starts(passages, size)
        runs = pa.concat_arrays(runs)
        start, n, *names, across = runs.flatten()
        start, n = start.to_numpy(), n.to_numpy()
        row, i = _counted(n)
        found = again[np.repeat(begin, np.concatenate(counts))[row] + start[row] + i]
        same = row[1:] == row[:-1]
        # Windows in a row that occur twice are one run again.
        low = np.flatnonzero(found & np.concatenate(([True], ~(found[:-1] & same)))[: len(row)])
        high = np.flatnonzero(found & np.concatenate((~(found[1:] & same), [True]))[: len(row)])
        of = pa.array(row[low])
        key, part, k = (x.take(of) for x in names)
        moved = pa.array(k.to_numpy() + i[low])
        return pa.RecordBatch.from_arrays(
            [key, part, moved, pa.array(high - low + 1), across.take(of)], ["key", "part", "k", "n", "across"]
        )

    def certify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, passages, counts, runs = None, [], [], []
        for batch in batches:
            shards, lists = batch.column(0).to_numpy(), batch.column(2)
            cuts = np.flatnonzero(shards[1:] != shards[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)], strict=True):
                if a == b:
                    continue
                if shards[a] != shard:
                    if passages:
                        yield certified(passages, counts, runs)
                    shard, passages, counts, runs = shards[a], [], [], []
                own = lists.slice(a, b - a)
                passages += batch.column(1).slice(a, b - a).to_pylist()
                counts.append(np.diff(own.offsets.to_numpy()))
                runs.append(own.flatten())
        if passages:
            yield certified(passages, counts, runs)

    return certify


def repeated_bytes(docs: DataFrame, size: int = 200, folder: str | None = None) -> DataFrame:
    """``doc_id, text_hash, spans``: the byte spans ``start, end`` to remove, sorted.

    They cover the windows of ``size`` bytes of the UTF-8 text that start at a second place
    too, in the same document or another; spans may overlap and touch. Documents without any
    have no row. ``text_hash`` is ``xxhash64(text)``.

    Null and empty texts and texts of fewer than ``size`` bytes have no windows. A null
    ``doc_id`` is an id like others. Rows that repeat both id and text are one document. An
    empty table gives no rows; other columns are ignored. Places are looked up by 64-bit
    hashes; that two are equal is decided on their bytes, by neighbours in a suffix array.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    found = stored(contexts(docs, byte_units, size, GRAM), folder, "contexts")
    shared = found.groupBy("anchor").agg(F.count("*").alias("places")).where("places > 1").select("anchor")
    rows = stored(found.join(shared, "anchor"), folder, "candidates")
    some = rows.select("doc_id", "text_hash").distinct()
    texts = passing(docs, text_filter(some)).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    texts = texts.alias("t").join(some.alias("s"), _same_row("t", "s"), "left_semi")
    texts = stored(texts.dropDuplicates(["doc_id", "text_hash"]), folder, "texts")

    orders, units = _orders(rows, texts, size, folder)
    orders = orders.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("shard", "start", "n", "run"))).alias("orders")
    )
    passages = texts.alias("t").join(orders.alias("o"), _same_row("t", "o")).select("text", "orders")
    kind = "struct<start:bigint,n:bigint,key:bigint,part:bigint,k:bigint,across:boolean>"
    passages = passages.mapInArrow(_cut_passages(size), f"shard long, passage binary, runs array<{kind}>")
    certified = (
        passages.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_certify(size), "key long, part long, k long, n long, across boolean")
    )
    certified = stored(certified, folder, "certified")
    # Only now every context gets what was certified of its units.
    across = certified.where("across").select(F.col("key").alias("core"), "part", "k", "n")
    across = units.join(across, ["core", "part"]).select("anchor", "context", (F.col("i") + F.col("k")).alias("i"), "n")
    plain = certified.where("NOT across").select(
        F.col("key").alias("anchor"), F.col("part").alias("context"), F.col("k").alias("i"), "n"
    )
    certified = plain.unionByName(across).groupBy("anchor", "context").agg(
        F.collect_set(F.struct("i", "n")).alias("runs")
    )
    spans = rows.drop("n").join(certified, ["anchor", "context"]).select(
        "doc_id",
        "text_hash",
        F.transform(
            "runs",
            lambda r: F.struct(
                (F.col("start") + r["i"]).alias("start"), (F.col("start") + r["i"] + r["n"] - 1 + size).alias("end")
            ),
        ).alias("spans"),
    )
    return spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))


def _remove(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """``spans`` are sorted by start; null where there are none."""
    data = texts.fill_null("").cast(pa.binary()).to_pylist()
    n = np.array([len(x) for x in data], np.int64)
    kept, removed, counts = list(data), np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
    if spans.null_count < len(spans):
        doc = np.repeat(np.arange(len(spans)), pc.list_value_length(spans).fill_null(0).to_numpy())
        start, end = (spans.flatten().field(x).to_numpy() for x in ("start", "end"))
        # Spans that touch or overlap are one.
        step = end.max(initial=0) + 1
        reach = np.maximum.accumulate(end + doc * step) - doc * step
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])))[: len(doc)]
        first = np.flatnonzero(new)
        doc, start, end = doc[first], start[first], reach[np.append(first[1:], len(doc))[: len(first)] - 1]
        counts = np.bincount(doc, minlength=len(data))
        np.add.at(removed, doc, end - start)
        cuts, ends = np.cumsum(counts) - counts, np.cumsum(counts)
        for d in np.flatnonzero(counts).tolist():
            text, own = data[d], slice(cuts[d], ends[d])
            begins = [0, *end[own].tolist()]
            kept[d] = b"".join([text[a:b] for a, b in zip(begins, [*start[own].tolist(), len(text)], strict=True)])
    columns = [pa.array(n), pa.array(removed), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())]
    return pa.StructArray.from_arrays(columns, ["n_bytes", "n_removed", "n_spans", "kept"])


def remove_bytes(docs: DataFrame, size: int = 200, folder: str | None = None) -> DataFrame:
    """``docs`` with ``deduplicated``: ``n_bytes, n_removed, n_spans, kept``.

    ``kept`` holds the bytes outside the maximal runs of ``repeated_bytes``; it is binary, as a
    run may begin or end within a character. All rows and columns stay (a column
    ``deduplicated`` is replaced); a null text has no bytes.
    """
    folder = folder or work_folder(docs.sparkSession)
    found = stored(repeated_bytes(docs, size, folder), folder, "spans")
    kind = "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept:binary>"
    remove = F.arrow_udf(_remove, kind)
    columns = [c for c in docs.columns if c != "deduplicated"]
    same = (F.xxhash64("d.text") == F.col("f.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
    test = text_filter(found)
    joined = passing(docs.select(*columns), test).alias("d").join(found.alias("f"), same, "left")
    joined = joined.select(*(F.col(f"d.{c}") for c in columns), remove("d.text", "f.spans").alias("deduplicated"))
    rest = docs.select(*columns).withColumn("deduplicated", of_the_rest(_remove, kind, test))
    return joined.unionByName(rest.where(F.col("deduplicated").isNotNull()))
