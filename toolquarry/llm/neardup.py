"""Near-duplicates by improved consistent weighted sampling of TF-IDF shingles.

A text is a bag of shingles of five words; a shingle weighs its count times the mean inverse
document frequency of its words. Frequencies cover all documents and are kept for hashed
words in a table of fixed size. Each sample of a text is equal for two texts with the
probability of their weighted Jaccard similarity; bands of samples propose pairs, and the
exact weighted Jaccard similarity of both whole texts decides on each.

Texts of equal words are one node from the start, so copies cost nothing further on. In a
bucket, members are compared with a leader, those it does not match with the next one, and so
on: a bucket of matching texts gives one pair per member. The leader is the member that shares
most buckets with others, as an original does with its edited copies. Classes are connected
components. Where a bucket still holds several, members of the smaller ones are compared with
the hub of the largest, the text with most links in it, so that a text left over costs one pair
and not one per text of the class.

What the leaders leave open is settled exactly. The texts of buckets that still hold an untested
pair of different classes meet by the rarest shingles of each, which every matching pair shares;
lengths and places of these bound the similarity. First each text is compared with one text of the
largest class at each such shingle, one pair per text and shingle however large the class, and
classes that this links are joined. Only then all pairs of the classes left are made and compared.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import gram_hashes, mix, separators, within_rows, word_hashes, words
from .work import appended, stored, text_chunks, work_folder

SPACE = ((0x20, 0x20), (0x09, 0x0D))
SHINGLE = 5
BANDS, ROWS = 8, 2
IDF_SLOTS = 1 << 20
ROUNDS = 3
TASK_PAIRS = 1_000
# Pairs of two classes compared before classes are joined again; more each time.
FIRST_PAIRS, MORE_PAIRS = 100, 16
ORDER_SLOTS = 1 << 20
SLACK = 1e-6

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = 1 << 16


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return words(data, offsets, separators(*SPACE))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each slot of hashed words occurs, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(IDF_SLOTS, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for _, data, offsets in text_chunks(batch.column(0)):
                data = _LOWER[data]
                starts, ends, rows = _words(data, offsets)
                slot = (word_hashes(data, starts, ends) % np.uint64(IDF_SLOTS)).astype(np.int64)
                row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
                once = np.unique(row * IDF_SLOTS + slot)
                total += np.bincount(once % IDF_SLOTS, minlength=IDF_SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(total[used], texts))], ["slot", "n"]
        )

    counts = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(count, "slot long, n long")
    table = counts.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slots, n = table["slot"].to_numpy(), table["n"].to_numpy()
    out = np.zeros(IDF_SLOTS, np.int64)
    out[slots[slots >= 0]] = n[slots >= 0]
    return out, int(n[slots < 0].sum())


def idf_table(frequencies: np.ndarray, texts: int) -> np.ndarray:
    """From 1 for a word of every text to 2 for a word of one, so that no word decides alone."""
    return (1 + np.log((2 + texts) / (1 + frequencies)) / np.log(2 + texts)).astype(np.float32)


def weighted_shingles(data, starts, ends, rows, idf):
    """``row, shingle, weight`` of the distinct shingles of each row, in order of row."""
    hashed = word_hashes(data, starts, ends)
    at = within_rows(rows, SHINGLE)
    shingle = gram_hashes(hashed, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    sums = np.concatenate(([0.0], np.cumsum(idf[(hashed % np.uint64(IDF_SLOTS)).astype(np.int64)], dtype=np.float64)))
    weight = (sums[at + SHINGLE] - sums[at]) / SHINGLE
    row = np.searchsorted(rows, at, "right") - 1
    order = np.lexsort((shingle, row))
    row, shingle, weight = row[order], shingle[order], weight[order]
    if not len(row):
        return row, shingle, weight
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1]))))
    times = np.diff(np.append(first, len(row)))
    # rounded, so that the order of the sums of different texts makes no difference
    return row[first], shingle[first], np.round(weight[first], 4) * times


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 and scale 1, at the middle of each step."""
    p = (np.arange(_STEPS) + 0.5) / _STEPS
    low, high = np.zeros(_STEPS), np.full(_STEPS, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - np.exp(-middle) * (1 + middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


def weighted_samples(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and ``n`` consistent weighted samples of each."""
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    gamma = _gamma_quantiles()
    log_gamma = np.log(gamma)
    log_weight = np.log(weight)
    size = np.diff(np.append(first, len(row)))
    out = np.empty((len(first), n), np.uint64)
    for k in range(n if len(first) else 0):
        random = mix(shingle + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF))
        low = (random & np.uint64(_STEPS - 1)).astype(np.int64)
        r = gamma[low]
        c = log_gamma[((random >> np.uint64(16)) & np.uint64(_STEPS - 1)).astype(np.int64)]
        beta = (random >> np.uint64(32)).astype(np.float64) / 2.0**32
        t = np.floor(log_weight / r + beta)
        a = c - r * (t - beta) - r
        least = np.repeat(np.minimum.reduceat(a, first), size)
        name = np.where(a == least, mix(shingle ^ mix(t.astype(np.int64).view(np.uint64))), np.uint64(0xFFFFFFFFFFFFFFFF))
        out[:, k] = np.minimum.reduceat(name, first)
    return row[first], out


def _sketches(idf: Broadcast):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands = [None] * batch.num_rows, [None] * batch.num_rows
            for at, data, offsets in text_chunks(batch.column(2)):
                data = _LOWER[data]
                starts, ends, rows = _words(data, offsets)
                raw = data.tobytes()
                for r in np.flatnonzero(np.diff(rows) > 0):
                    own = raw[offsets[r] : offsets[r + 1]]
                    keys[at + r] = hashlib.md5(b" ".join(own.split())).digest()
                found, samples = weighted_samples(*weighted_shingles(data, starts, ends, rows, idf.value), BANDS * ROWS)
                for b in range(BANDS):
                    key = samples[:, b * ROWS].copy()
                    for s in range(1, ROWS):
                        key = mix(key * np.uint64(31) + samples[:, b * ROWS + s])
                    samples[:, b] = mix(key + np.uint64(b))
                for r, row in zip(found.tolist(), samples[:, :BANDS].view(np.int64), strict=True):
                    bands[at + r] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "node", "bands"],
            )

    return sketch


def shingle_weights(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a whole text, sorted, and their weights."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    starts, ends, rows = _words(data, np.array([0, len(data)]))
    return weighted_shingles(data, starts, ends, rows, idf)[1:]


def similarity(one: tuple, two: tuple) -> float:
    """Weighted Jaccard similarity of two results of ``shingle_weights``."""
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    shared = np.minimum(one[1][i], two[1][j]).sum()
    total = one[1].sum() + two[1].sum() - shared
    return float(shared / total) if total else 0.0


def _compare(idf: Broadcast):
    """Rows sorted by ``leader, task, is_member`` to ``node, leader, similarity``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = None
        for batch in batches:
            nodes, leaders, close = [], [], []
            for r in range(batch.num_rows):
                own = shingle_weights(batch.column(4)[r].as_py().encode(), idf.value)
                if not batch.column(2)[r].as_py():
                    leader = own
                    continue
                nodes.append(batch.column(3)[r])
                leaders.append(batch.column(0)[r])
                close.append(similarity(own, leader))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n.as_py() for n in nodes], pa.binary()),
                    pa.array([n.as_py() for n in leaders], pa.binary()),
                    pa.array(close, pa.float64()),
                ],
                ["node", "leader", "similarity"],
            )

    return compare


def _similarities(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """``node, leader, similarity`` of pairs; a leader's text is sent once per task.

    A leader of many members is compared in several tasks.
    """
    load = pairs.groupBy("leader").agg(F.ceil(F.count("*") / TASK_PAIRS).alias("tasks"))
    members = pairs.join(load, "leader").select(
        "leader", F.pmod(F.xxhash64("node"), F.col("tasks")).alias("task"), F.lit(True).alias("is_member"), "node"
    )
    leaders = load.select(
        "leader",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"),
        F.lit(False).alias("is_member"),
        F.col("leader").alias("node"),
    )
    rows = members.unionByName(leaders).join(texts, "node").select("leader", "task", "is_member", "node", "text")
    rows = rows.repartition("leader", "task").sortWithinPartitions("leader", "task", "is_member")
    return rows.mapInArrow(_compare(idf), "node binary, leader binary, similarity double")


def _shingle_order(texts: DataFrame, idf: Broadcast) -> np.ndarray:
    """How often the shingles of each slot occur; slots that are shared only cost time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ORDER_SLOTS, np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                data = _LOWER[data]
                _, shingle, _ = weighted_shingles(data, *_words(data, offsets), idf.value)
                slot = (shingle % np.uint64(ORDER_SLOTS)).astype(np.int64)
                total += np.bincount(slot, minlength=ORDER_SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    counts = texts.select("text").mapInArrow(count, "slot long, n long")
    table = counts.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(ORDER_SLOTS, np.int64)
    out[table["slot"].to_numpy()] = table["n"].to_numpy()
    return out


def _prefixes(idf: Broadcast, order: np.ndarray, threshold: float):
    """``node, text`` to the shingles of each text that a matching one may share first.

    Shingles stand in one order for all texts, rare ones first. What two texts share lies at or
    behind the first shared shingle, so there at least ``threshold`` of each weight is left.
    """

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_chunks(batch.column(1)):
                data = _LOWER[data]
                row, shingle, weight = weighted_shingles(data, *_words(data, offsets), idf.value)
                if not len(row):
                    continue
                rank = order[(shingle % np.uint64(ORDER_SLOTS)).astype(np.int64)]
                by = np.lexsort((shingle, rank, row))
                row, shingle, weight = row[by], shingle[by], weight[by]
                first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                size = np.diff(np.append(first, len(row)))
                total = np.repeat(np.add.reduceat(weight, first), size)
                before = np.concatenate(([0.0], np.cumsum(weight)))[:-1]
                rest = total - (before - np.repeat(before[first], size))
                keep = np.flatnonzero(rest >= threshold * total * (1 - SLACK))
                rows = pa.array(at + row[keep])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        pa.array(shingle[keep].view(np.int64)),
                        pa.array(total[keep]),
                        pa.array(rest[keep]),
                    ],
                    ["node", "shingle", "total", "rest"],
                )

    return prefix


def _open_buckets(members: DataFrame, asked: DataFrame, roots: DataFrame) -> DataFrame:
    """``bucket, major`` of each that holds a pair of different classes which no leader tested.

    ``asked`` are the pairs that leaders tested without a match, ``major`` is the class of most
    members. Leaders settle buckets of up to three members, so only larger ones are looked at.
    """
    large = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 3").select("bucket")
    named = members.join(large, "bucket").join(roots, "node", "left").select("bucket", F.coalesce("root", "node").alias("root"))
    count = named.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket")
    count = count.agg(
        ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
        F.max(F.struct("n", "root"))["root"].alias("major"),
    ).where("pairs > 0")
    own = roots.select("node", F.col("root").alias("node_root"))
    lead = roots.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
    # Counted by class before leaders get theirs: one row per leader and class of a bucket.
    tests = asked.join(count.select("bucket"), "bucket").join(own, "node", "left")
    tests = tests.groupBy("bucket", "leader", F.coalesce("node_root", "node").alias("class")).agg(F.count("*").alias("n"))
    apart = tests.join(lead, "leader", "left").where(F.col("class") != F.coalesce("leader_root", "leader"))
    done = apart.groupBy("bucket").agg(F.sum("n").alias("done"))
    still = count.join(done, "bucket", "left").where(F.col("pairs") > F.coalesce("done", F.lit(0)))
    return still.select("bucket", "major")


def _hub_pairs(members: DataFrame, still: DataFrame, links: DataFrame, roots: DataFrame) -> DataFrame:
    """``node, leader``: members of open buckets with the hub of the class that prevails there."""
    degree = links.groupBy(F.col("leader").alias("node")).agg(F.count("*").alias("degree"))
    hubs = degree.join(roots, "node").groupBy("root").agg(F.max(F.struct("degree", "node"))["node"].alias("hub"))
    named = members.join(still, "bucket").join(roots, "node", "left")
    apart = named.where(F.coalesce("root", "node") != F.col("major")).select("node", "major").distinct()
    lead = hubs.select(F.col("root").alias("major"), "hub")
    return apart.join(lead, "major", "left").select("node", F.coalesce("hub", "major").alias("leader")).distinct()


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """``pairs`` that were not compared, either way round."""
    known = tested.select(F.greatest("node", "leader").alias("high"), F.least("node", "leader").alias("low"))
    pairs = pairs.withColumn("high", F.greatest("node", "leader")).withColumn("low", F.least("node", "leader"))
    return pairs.join(known, ["high", "low"], "left_anti").dropDuplicates(["high", "low"]).select("node", "leader")


def _prefix_keys(texts: DataFrame, idf: Broadcast, threshold: float, folder: str) -> DataFrame:
    """``node, shingle, total, rest`` of ``texts`` (``node, text``), for shingles of several texts."""
    order = _shingle_order(texts, idf)
    keys = texts.select("node", "text").mapInArrow(
        _prefixes(idf, order, threshold), "node binary, shingle long, total double, rest double"
    )
    keys = stored(keys, folder, "prefixes")
    shared = keys.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    return stored(keys.join(shared, "shingle"), folder, "prefixes_shared", keys.count())


def _mixed_keys(keys: DataFrame, roots: DataFrame) -> DataFrame:
    """``keys`` of shingles in several classes, with ``root``, the largest class (``major``) and ``parts``."""
    keys = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = keys.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("shingle").agg(
        F.max_by("root", "n").alias("major"), F.sum("n").alias("n"), F.count("*").alias("roots")
    )
    mixed = mixed.where("roots > 1").select("shingle", "major", F.ceil(F.col("n") / TASK_PAIRS).alias("parts"))
    return keys.join(mixed, "shingle")


def _least_share(threshold: float) -> float:
    """Of the weight of both, what two matching texts share at least."""
    return threshold / (1 + threshold) * (1 - SLACK)


def _partners(keys: DataFrame, threshold: float, step: int) -> DataFrame:
    """``node, leader``: texts outside of the largest class of a shingle with one text in it.

    First that with least of its own, as an original has; another one at each further step.
    """
    choice = F.col("rest") / F.col("total") if step == 0 else F.xxhash64("node", "shingle", F.lit(step))
    one = F.max(F.struct(choice.alias("choice"), "node", "total", "rest")).alias("p")
    partner = keys.where("root = major").groupBy("shingle").agg(one)
    pairs = keys.where("root <> major").join(partner, "shingle")
    close = F.least("rest", "p.rest") >= _least_share(threshold) * (F.col("total") + F.col("p.total"))
    return pairs.where(close).select("node", F.col("p.node").alias("leader"))


def _possible_pairs(keys: DataFrame, threshold: float) -> DataFrame:
    """``node, leader``: all pairs of different roots in ``_mixed_keys`` that may match."""
    share = _least_share(threshold)
    # Of two matching texts the one of less weight has this much left at the first shared shingle.
    keys = keys.withColumn("early", F.col("rest") >= 2 * share * F.col("total"))
    # The largest class of a shingle is never held against itself; a hot shingle is dealt out by node.
    left = keys.where("root <> major").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    right = keys.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    found = None
    for early in (True, False):
        one = left.where(F.col("early") == early).alias("l")
        two = (right if early else right.where("early")).alias("r")
        close = (
            (F.col("l.shingle") == F.col("r.shingle"))
            & (F.col("l.part") == F.col("r.part"))
            & (F.col("l.root") != F.col("r.root"))
            & (F.least("l.rest", "r.rest") >= share * (F.col("l.total") + F.col("r.total")))
        )
        pairs = one.join(two, close).select(
            F.greatest("l.node", "r.node").alias("node"), F.least("l.node", "r.node").alias("leader")
        )
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def _joined_classes(roots: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """Roots once ``links`` (``node, leader``) have joined classes."""
    # classes so far stand for the links that made them
    before = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(before.union(links.select("node", "leader")), folder)


def _settle(pairs: DataFrame, roots: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float, folder: str):
    """Roots after all of ``pairs`` are compared, but for those whose texts are of one class by then."""
    limit, step, n = FIRST_PAIRS, 0, pairs.count()
    while True:
        own = roots.select("node", F.col("root").alias("node_root"))
        lead = roots.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
        named = pairs.join(own, "node", "left").join(lead, "leader", "left").select(
            "node", "leader", F.coalesce("node_root", "node").alias("one"), F.coalesce("leader_root", "leader").alias("two")
        )
        named = named.where("one <> two").select("node", "leader", F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two"))
        named = stored(named, folder, f"open_{step}", n)
        if named.isEmpty():
            return roots
        parts = named.groupBy("one", "two").agg(F.ceil(F.count("*") / limit).alias("parts"))
        turn = named.join(parts, ["one", "two"]).withColumn("now", F.pmod(F.xxhash64("node", "leader"), F.col("parts")) == 0)
        turn = stored(turn.select("node", "leader", "now"), folder, f"turn_{step}", n)
        compared = stored(
            _similarities(turn.where("now").select("node", "leader"), texts, idf), folder, f"settled_{step}", n
        )
        close = compared.where(F.col("similarity") >= threshold).select("node", "leader")
        if not close.isEmpty():
            roots = _joined_classes(roots, close, f"{folder}/classes_{step}")
        pairs, limit, step = turn.where("NOT now").select("node", "leader"), limit * MORE_PAIRS, step + 1


def _settled(texts: DataFrame, roots: DataFrame, tested: DataFrame, idf: Broadcast, threshold: float, folder: str):
    """Roots once all pairs of ``texts`` (``node, text``) of different classes are settled."""
    keys = _prefix_keys(texts, idf, threshold, folder)
    n = keys.count()
    for step in range(ROUNDS + 1):
        mixed = stored(_mixed_keys(keys, roots), folder, f"prefixes_mixed_{step}", n)
        if step == ROUNDS:
            break
        pairs = stored(_untested(_partners(mixed, threshold, step), tested), folder, f"partners_{step}", n)
        if pairs.isEmpty():
            break
        now = stored(_similarities(pairs, texts, idf), folder, f"partners_compared_{step}", n)
        tested = appended(now, folder, "compared", n)
        close = now.where(F.col("similarity") >= threshold)
        if close.isEmpty():
            break
        roots = _joined_classes(roots, close, f"{folder}/partnered_{step}")
    pairs = stored(_untested(_possible_pairs(mixed, threshold), tested), folder, "possible")
    return _settle(pairs, roots, texts, idf, threshold, folder)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, folder: str | None = None) -> DataFrame:
    """``doc_id, text_hash, class_id, class_size``, one row per row of ``docs``.

    ``class_id`` is the smallest ``doc_id`` among the texts linked with each other, directly
    or through others, by a similarity of ``threshold`` or more, ``class_size`` the number of
    its rows. ``text_hash`` is ``xxhash64(text)``.

    Texts of fewer than five words have no shingle and match only texts of the same words. Texts
    without a word, null ones among them, are alone in a class of their row (two such rows of
    one id share it). A null ``doc_id`` takes part; it names a class
    only where no other id does. Repeated rows are members like others. An empty table gives
    no rows; other columns are ignored.

    A pair of similarity ``s`` meets in a bucket with probability ``1 - (1 - s**2)**8``,
    99.97% at 0.8. Members of a bucket that no leader matched yet are compared with the next,
    for ``ROUNDS`` leaders; one that is linked already leads before one that is not. Pairs that
    no leader tested are then all settled, but for those within a class already.
    """
    return _classes(docs, threshold, folder).drop("root")


def _classes(docs: DataFrame, threshold: float, folder: str | None) -> DataFrame:
    """The rows of ``near_duplicates`` with the root node of their class."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    frequencies, texts = document_frequencies(docs)
    idf = spark.sparkContext.broadcast(idf_table(frequencies, texts))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketched = stored(
        rows.mapInArrow(_sketches(idf), f"doc_id {id_type}, text_hash long, node binary, bands array<long>"),
        folder,
        "sketches",
    )
    # Copies are one node; counted in the tasks first, so many copies are no hot group.
    nodes = sketched.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("own"),
        F.count("*").alias("n"),
        F.first("bands").alias("bands"),
    )
    nodes = stored(nodes, folder, "nodes", texts)
    most = BANDS * texts  # members of buckets
    members = nodes.select("node", F.posexplode("bands").alias("band", "bucket")).select("bucket", "node")
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(shared, "bucket"), folder, "shared", most)
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    members = stored(members.drop("size").join(score, "node"), folder, "members_0", most)
    # The text of every node in a shared bucket, once.
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "own.*").withColumnRenamed("text_hash", "own_hash")
    same = (F.col("w.own_hash") == F.col("d.text_hash")) & F.col("w.doc_id").eqNullSafe(F.col("d.doc_id"))
    node_texts = rows.where("text IS NOT NULL").alias("d").join(wanted.alias("w"), same).select("node", "text")
    node_texts = stored(node_texts.dropDuplicates(["node"]), folder, "texts")

    first_members = members.select("bucket", "node")
    members = members.withColumn("linked", F.lit(False))
    asked, tested = None, None
    for step in range(ROUNDS):
        # Who is linked already leads first: the original behind an edited copy, for one.
        leaders = members.groupBy("bucket").agg(
            F.max(F.struct("linked", "score", "node"))["node"].alias("leader"), F.min("linked").alias("done")
        )
        led = stored(
            members.join(leaders.where("NOT done"), "bucket").where("node <> leader"), folder, f"led_{step}", most
        )
        pairs = led.where("NOT linked").select("node", "leader").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["node", "leader"], "left_anti")
        tested = appended(_similarities(pairs, node_texts, idf), folder, "compared", most)
        links = tested.where(F.col("similarity") >= threshold).select("node", "leader")
        found = links.withColumn("found", F.lit(True))
        led = led.join(found, ["node", "leader"], "left").withColumn("found", F.col("found").isNotNull())
        led = stored(led, folder, f"found_{step}", most)
        asked = appended(led.where("NOT linked AND NOT found").select("bucket", "node", "leader"), folder, "asked", most)
        members = led.withColumn("linked", F.col("linked") | F.col("found")).select(*members.columns)
        if members.where("NOT linked").isEmpty():
            break
    for step in range(ROUNDS + 1):
        classes = components(links.select(F.col("node").alias("a"), F.col("leader").alias("b")), f"{folder}/rooted_{step}", most)
        left_open = stored(_open_buckets(first_members, asked, classes), folder, f"open_buckets_{step}", most)
        if step == ROUNDS or left_open.isEmpty():
            break
        pairs = stored(_untested(_hub_pairs(first_members, left_open, links, classes), tested), folder, f"hub_pairs_{step}", most)
        if pairs.isEmpty():
            break
        now = stored(_similarities(pairs, node_texts, idf), folder, f"hub_compared_{step}", most)
        tested = appended(now, folder, "compared", most)
        links = tested.where(F.col("similarity") >= threshold).select("node", "leader")
        if now.where(F.col("similarity") >= threshold).isEmpty():
            break
    if not left_open.isEmpty():
        kept = first_members.join(left_open, "bucket").select("node").distinct()
        open_texts = stored(kept.join(node_texts, "node"), folder, "open_texts")
        classes = _settled(open_texts, classes, tested, idf, threshold, folder)
    idf.destroy()  # all that needs it is stored
    rooted = nodes.join(classes, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.col("own.doc_id").alias("own_id"), "n"
    )
    named = rooted.groupBy("root").agg(F.min("own_id").alias("class_id"), F.sum("n").alias("class_size"))
    named = rooted.select("node", "root").join(named, "root")
    return sketched.join(named, "node", "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        "root",
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, folder: str | None = None) -> DataFrame:
    """``docs`` with one document of each class of near-duplicates, that of the smallest id.

    Ties of id go to the smaller text hash, and null ids come last. Rows that repeat both id
    and text are one document and stay or go together; rows without a word all stay. Columns stay as they are.
    """
    found = _classes(docs, threshold, folder).where("class_size > 1")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = found.groupBy("root").agg(F.min(key).alias("first"))
    gone = found.join(first, "root").where(key != F.col("first")).select("doc_id", "text_hash").distinct()
    same = (F.xxhash64(F.col("d.text")) == F.col("g.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))
    return docs.alias("d").join(gone.alias("g"), same, "left_anti")
