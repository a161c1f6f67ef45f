"""Source divergence audit: how far the sources of a language differ in their terms.

Arrow kernels count inside the tasks: texts are lower-cased and split, terms are
dictionary-encoded, and hash aggregation gives counts per document, then per language, source
and term. A task merges its partial counts as it goes and hands them on when they reach a bound,
so it holds no more than that. Spark merges the partial counts of all tasks.

Divergences come from columnar shards of the merged counts: a shard holds some terms of a
language with all their sources (of two tiles of sources, where there are many), in order, and
streams through as blocks of a matrix ``terms x sources``. Terms that neither of two sources has
are not visited: they all add the same. All arithmetic is on whole numbers.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import CHUNK_BYTES, stored, work_folder

# Fixed values of the audit.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200

MERGE_ROWS = 1 << 19  # partial counts that a task holds
TILE = 512  # sources on one side of a matrix of pairs
SHARD_ROWS = 1 << 18  # counts of one shard, as long as there are tasks for more shards
BLOCK = 1 << 20  # cells of one matrix block

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_KEYS = ["lang", "source", "term"]


def _encoded(column: pa.Array) -> pa.DictionaryArray:
    return pc.dictionary_encode(pc.fill_null(column, ""))


def count_terms(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.Table:
    """Occurrences and documents per language, source and term; a row without a term counts the documents."""
    rows = len(texts)
    langs, sources = _encoded(langs), _encoded(sources)
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    terms = pc.dictionary_encode(pc.list_flatten(split))
    found = pa.table({"row": pc.list_parent_indices(split), "term": terms.indices})
    if (empty := pc.index(terms.dictionary, "").as_py()) >= 0:  # before the first or after the last term
        found = found.filter(pc.not_equal(found["term"], empty))
    found = found.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    found = pa.table(
        {
            "lang": pc.take(langs.indices, found["row"]),
            "source": pc.take(sources.indices, found["row"]),
            "term": found["term"],
            "n": found["count_all"],
        }
    )
    found = found.group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    every = pa.table({"lang": langs.indices, "source": sources.indices, "docs": pa.array(np.ones(rows, np.int64))})
    every = every.group_by(["lang", "source"], use_threads=False).aggregate([("docs", "sum")])
    counted = pa.table(
        [langs.dictionary.take(found["lang"].combine_chunks()), sources.dictionary.take(found["source"].combine_chunks()),
         terms.dictionary.take(found["term"].combine_chunks()), found["n_sum"], found["n_count"]],
        schema=_COUNTS,
    )
    groups = pa.table(
        [langs.dictionary.take(every["lang"].combine_chunks()), sources.dictionary.take(every["source"].combine_chunks()),
         pa.nulls(len(every), pa.string()), pa.array(np.zeros(len(every), np.int64)), every["docs_sum"]],
        schema=_COUNTS,
    )
    return pa.concat_tables([counted, groups])


def _merged(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return table.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns(_COUNTS.names)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with about ``CHUNK_BYTES`` of text; a longer text comes alone and whole."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(sizes):
        before = sizes[first - 1] if first else 0
        last = max(int(np.searchsorted(sizes, before + CHUNK_BYTES, "right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def _by_term(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """A row per language and term, with its sources and their counts as lists."""
    lists = [(c, "list") for c in ("source", "n", "docs")]
    table = table.group_by(["lang", "term"], use_threads=False).aggregate(lists)
    table = table.select(["lang", "term", "source_list", "n_list", "docs_list"])
    return iter(table.rename_columns(["lang", "term", "sources", "ns", "docs"]).combine_chunks().to_batches(max_chunksize=1 << 13))


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows (``text, lang, source``), merged while they stay below a bound."""
    held, rows = [], 0
    for batch in batches:
        for part in _slices(batch):
            held.append(count_terms(part.column("text"), part.column("lang"), part.column("source")))
            rows += held[-1].num_rows
            if rows > 2 * MERGE_ROWS:
                held = [_merged(held)]
                rows = held[0].num_rows
                if rows > MERGE_ROWS:
                    yield from _by_term(held[0])
                    held, rows = [], 0
    if held:
        yield from _by_term(_merged(held))


def term_counts(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms ``lang, source, term, n, lang_n``, and all groups with their totals.

    A group has ``n_total`` occurrences of kept terms, its language ``lang_total`` of ``v`` terms.
    """
    read = docs.select(*(F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")))
    lists = "lang string, term string, sources array<string>, ns array<bigint>, docs array<bigint>"
    counts = read.mapInArrow(partial_counts, lists).repartition("lang", "term")  # a row per task and term
    counts = counts.select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("ns").alias("n"), "docs")))
    counts = counts.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    kept = counts.select(
        *_KEYS,
        "n",
        F.sum("docs").over(of_term).alias("docs"),
        F.sum("n").over(of_term).alias("lang_n"),
        (F.row_number().over(of_term.orderBy("source")) == 1).alias("first"),
    )
    kept = stored(kept.where((F.col("docs") >= LEAST_DOCS) | F.col("term").isNull()).drop("docs"), folder, "kept")
    every, kept = kept.where("term IS NULL"), kept.where("term IS NOT NULL")
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n_total"), F.sum(F.col("first").cast("long")).alias("v"), F.count("*").alias("n_rows")
    )
    groups = every.select("lang", "source").join(sums, ["lang", "source"], "left").fillna(0, ["n_total", "v", "n_rows"])
    of_lang = Window.partitionBy("lang")  # a row per source
    groups = groups.select(
        "lang",
        "source",
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"),
        F.count("*").over(of_lang).cast("int").alias("sources"),
        "n_total",
        *(F.sum(c).over(of_lang).alias(name) for c, name in (("n_total", "lang_total"), ("v", "v"), ("n_rows", "lang_rows"))),
    )
    return kept.drop("first"), stored(groups, folder, "groups")


def _share(n: str, total: str) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + v))``; decimals hold the product, ``div`` is exact."""
    product = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(20,0))"
    return F.expr(f"1L + ({product}) div CAST({total} + v AS DECIMAL(20,0))")


def shares(counts: np.ndarray, wholes: np.ndarray) -> np.ndarray:
    """``1 + SCALE * (counts + 1) // wholes`` by long division in steps of a thousand."""
    rest = counts + 1
    out = rest // wholes
    rest = rest - out * wholes
    for _ in range(3):  # SCALE is 1000 ** 3
        rest = rest * 1000
        digit = rest // wholes
        out = out * 1000 + digit
        rest = rest - digit * wholes
    return out + 1


class _Shard:
    """Sums over some terms of a language, for all pairs of two tiles of sources."""

    def __init__(self, lang: str, a: int, b: int, first: bool):
        self.lang, self.a, self.b, self.first = lang, a, b, first
        self.groups: list[tuple[int, str, int, int]] = []
        self.sums = None
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def start(self):
        self.groups.sort()
        self.place = np.array([g[0] for g in self.groups])
        self.names = [g[1] for g in self.groups]
        v = self.groups[0][3]
        self.wholes = np.array([g[2] for g in self.groups], np.int64) + v
        tile = self.place // TILE
        self.left, self.right = np.flatnonzero(tile == self.a), np.flatnonzero(tile == self.b)
        # a term that neither source has: the same for all such terms; without terms there is nothing to add
        self.none = self.pairs(shares(np.zeros((1, len(self.place)), np.int64), self.wholes)) if v else 0
        self.sums = np.zeros((len(self.left), len(self.right)), np.int64) + (self.none * v if self.first else 0)

    def pairs(self, p: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.left), len(self.right)), np.int64)
        q = p[:, self.right]
        for i, s in enumerate(self.left):
            step = p[:, s : s + 1] - q
            out[i] = (step * step // q).sum(axis=0)
        return out

    def add(self, term: np.ndarray, place: np.ndarray, n: np.ndarray):
        """Counts of whole terms, told apart by ``term`` (ascending)."""
        if self.sums is None:
            self.start()
        at = np.searchsorted(self.place, place)
        new = np.concatenate(([True], term[1:] != term[:-1]))
        line = np.cumsum(new) - 1
        height = max(1, BLOCK // len(self.place))
        for low in range(0, int(line[-1]) + 1, height):
            i, j = np.searchsorted(line, (low, low + height))
            high = min(low + height, int(line[-1]) + 1)
            block = np.zeros((high - low, len(self.place)), np.int64)
            block[line[i:j] - low, at[i:j]] = n[i:j]
            self.sums += self.pairs(shares(block, self.wholes)) - (high - low) * self.none

    def result(self) -> Iterator[pa.RecordBatch]:
        if self.sums is None:
            self.start()
        for i, s in enumerate(self.left):
            others = [(self.names[t], int(x)) for t, x in zip(self.right, self.sums[i], strict=True) if t != s and (x or self.first)]
            if others:
                items, values = zip(*others, strict=True)
                k = len(others)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.lang] * k), pa.array([self.names[s]] * k), pa.array(items), pa.array(values, pa.int64())],
                    ["lang", "source", "item", "value"],
                )


def shard_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of every shard; rows in the order of shard, then groups, then terms."""
    shard, key = None, None
    held = None  # rows of terms whose last may go on in the next batch

    def flush(rows: pa.Table | None, whole: bool) -> pa.Table | None:
        if rows is None or not rows.num_rows:
            return None
        codes = pc.dictionary_encode(rows["term"].combine_chunks()).indices.to_numpy().astype(np.int64)
        end = len(codes) if whole else int(np.searchsorted(codes, codes[-1]))
        if end:
            shard.add(codes[:end], *(rows[c].to_numpy()[:end].astype(np.int64) for c in ("place", "n")))
        return rows.slice(end) if end < len(codes) else None

    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = [table[c].to_pylist() for c in ("lang", "a", "b", "shard")]
        keys = list(zip(*keys, strict=True))
        first = 0
        while first < len(keys):
            if keys[first] != key:
                if shard is not None:
                    held = flush(held, True)
                    yield from shard.result()
                key = keys[first]
                shard = _Shard(key[0], key[1], key[2], key[3] == 0)
            last = first + 1
            while last < len(keys) and keys[last] == key:
                last += 1
            part = table.slice(first, last - first)
            named = part["term"].is_valid().combine_chunks()
            for g in part.filter(pc.invert(named)).to_pylist():
                shard.groups.append((g["place"], g["source"], g["n_total"], g["v"]))
            rows = part.filter(named)
            held = flush(rows if held is None else pa.concat_tables([held, rows]), False)
            first = last
    if shard is not None:
        flush(held, True)
        yield from shard.result()


def source_pairs(kept: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of different sources of a language."""
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    n_shards = F.least(F.lit(shards), F.ceil(F.col("lang_rows") / SHARD_ROWS) + 1).cast("int")
    groups = groups.withColumns({"tiles": tiles, "shards": n_shards, "tile": F.floor(F.col("place") / TILE).cast("int")})
    sides = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.col("tiles") - 1),
            lambda o: F.array(F.struct(F.col("tile").alias("a"), o.alias("b")), F.struct(o.alias("a"), F.col("tile").alias("b"))),
        )
    )
    columns = ["lang", "side.a", "side.b", "shard", "place", "source", "n_total", "v", "term", "n"]
    groups = groups.withColumn("sides", F.array_distinct(sides))
    rows = kept.join(groups.drop("n_total", "v"), ["lang", "source"])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
    # the name and the totals of a source stand in its own row of a shard only
    rows = rows.withColumns({"source": F.lit(None).cast("string"), "n_total": F.lit(0).cast("long"), "v": F.lit(0).cast("long")})
    every = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    every = every.withColumns({"term": F.lit(None).cast("string"), "n": F.lit(0).cast("long")})
    dealt = [t.withColumn("side", F.explode("sides")).select(*columns) for t in (rows, every)]
    order = ["lang", "a", "b", "shard"]
    dealt = dealt[0].unionByName(dealt[1]).repartition(shards, *order).sortWithinPartitions(*order, F.asc_nulls_first("term"), "place")
    sums = dealt.mapInArrow(shard_sums, "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for the terms of a group with a greater share than in the language."""
    rows = kept.join(groups, ["lang", "source"])
    rows = rows.withColumns({"p": _share("n", "n_total"), "q": _share("lang_n", "lang_total")}).where("p > q")
    return rows.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))


def audit(docs: DataFrame, top: int = TOP, shards: int | None = None) -> DataFrame:
    """``lang, source, part, item, value, rank``: sources against each other and terms against the language.

    Part ``pair`` has every other source of the language, ``value`` is the divergence summed over
    all kept terms, 0 for a language without any. Part ``term`` has the ``top`` terms that
    are more frequent in the source than in the language. Ranks go by value, then by item.

    Null texts, languages and sources count as empty ones; a group of null and empty is one.
    Repeated rows are documents of their own. Groups without a term stand in part ``pair``. An
    empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept, groups = term_counts(docs, work_folder(spark))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(ranked).alias("rank")]
    pairs = source_pairs(kept, groups, shards).select(*columns("pair"))
    terms = term_divergence(kept, groups).select(*columns("term")).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
