"""Exact deduplication by an extendible-hash index on shared files.

A text is known by its normalised form (white space deleted) and entered under the hash of
that form. The index is three tables in the shared folder: the entries, the directory and the
chains. The directory starts with one bucket and doubles: a bucket with more entries than one
owner's share splits by the next bit of the hash, until all fit or the hash prefix has
``DEPTH`` bits. Buckets of lower depth stand in several directory entries. What cannot split
further, such as one text with very many copies, goes on in overflow pages, so that no owner
has more than its share. Entries of one hash form a chain. Owners read the texts of chains with
two entries or more, page by page, and compare them byte by byte; pages then meet with one row
per text. Texts that stand alone under their hash need no comparison.

DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import stored, work_folder

# The characters deleted before texts are compared.
SPACE = " \t\n\v\f\r"
DEPTH = 16  # bits of the directory, at most 65,536 entries: small enough to broadcast


def normalised(text: Column) -> Column:
    """``text`` without white space; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id``, code points of the text, its normalised form and the hash of that."""
    whole = F.coalesce(F.col(text), F.lit(""))
    read = docs.select("doc_id", F.length(whole).cast("long").alias("n_points"), normalised(F.col(text)).alias("form"))
    return read.withColumn("key", F.xxhash64("form"))


def _slot(key: str = "key") -> Column:
    return F.shiftrightunsigned(F.col(key), 64 - DEPTH).cast("int")


def directory(entries: DataFrame, share: int) -> DataFrame:
    """``slot, bucket, depth, pages`` for the directory's slots, ``2 ** DEPTH`` at most.

    Slots of buckets without an entry are left out. Loads of all prefixes are counted in one pass; a bucket is a leaf if it has at most
    ``share`` entries, or ``DEPTH`` bits, and the bucket that it was split from had more.
    """
    slots = entries.groupBy(_slot().alias("slot")).agg(F.count("*").alias("n"))
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("depth"))
    prefix = F.expr(f"shiftright(slot, {DEPTH} - depth)")
    loads = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("load"))
    above = loads.where(F.col("load") > share).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("split"), F.lit(True).alias("parted")
    )
    leaf = (F.col("load") <= share) | (F.col("depth") == DEPTH)
    leaves = loads.where(leaf).withColumn("split", F.when(F.col("depth") > 0, F.shiftright("prefix", 1)))
    leaves = leaves.join(above, ["depth", "split"], "left").where(F.col("parted") | (F.col("depth") == 0))
    first = F.expr(f"shiftleft(prefix, {DEPTH} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {DEPTH} - depth) - 1")
    pages = F.ceil(F.col("load") / share).cast("int")
    return leaves.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "depth", pages.alias("pages"))


def _owned(rows: DataFrame, slots: DataFrame, salt: Column) -> DataFrame:
    """``rows`` with the bucket of their key and a page of it."""
    rows = rows.withColumn("slot", _slot()).join(F.broadcast(slots.select("slot", "bucket", "pages")), "slot")
    return rows.withColumn("page", F.pmod(salt, F.col("pages")).cast("int")).drop("slot", "pages")


def _on_every_page(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """One row of ``rows`` for each page of the bucket of its key."""
    rows = rows.withColumn("slot", _slot()).join(F.broadcast(slots.select("slot", "bucket", "pages")), "slot")
    return rows.withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1))).drop("slot", "pages")


def exact_duplicates(docs: DataFrame, text: str = "text", owners: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_points, text_sha256, keep_id, group_size, kept``.

    Texts are equal if they are identical without the characters of ``SPACE``. Of equal
    texts the row with the most code points in its original text stays, then the one with
    the smallest ``doc_id`` (null last), then, of rows that agree in all of that, one.
    ``keep_id`` is the ``doc_id`` of the row that stays, ``group_size`` the number of rows.

    A null text counts as empty, and all empty texts are equal. Repeated rows are rows of
    their group. An empty table gives none. Other columns of ``docs`` are not read.
    ``owners`` is the number of tasks that share the index (the session's shuffle partitions).
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = _texts(docs, text).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_points", "key", F.sha2("form", 256).alias("text_sha256")
    )
    entries = stored(entries, folder, "entries")
    share = max(1, -(-entries.count() // owners))
    slots = stored(directory(entries, share), folder, "directory")

    chains = entries.groupBy("key").agg(F.count("*").alias("length")).where("length > 1").select("key")
    chains = stored(_on_every_page(chains, slots), folder, "chains")

    # Owners compare the texts of a page byte by byte; pages meet with a row per text.
    texts = _owned(_texts(docs, text), slots, F.xxhash64("doc_id", "n_points"))
    texts = texts.join(chains, ["bucket", "page", "key"], "left_semi")
    found = texts.groupBy("bucket", "page", "key", "form").agg(F.count("*").alias("n"))
    found = found.groupBy("key", "form").agg(F.sum("n").alias("n"))
    found = found.groupBy("key", F.sha2("form", 256).alias("text_sha256")).agg(
        F.count("*").alias("texts"), F.sum("n").alias("group_size")
    )
    # Rows find their text by both hashes, which the comparison has just shown to be one text's.
    two = F.raise_error(F.lit("two different texts agree in both of their hashes"))
    found = found.withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(two.cast("long")))

    order = F.struct(
        (-F.col("n_points")).alias("longest"), F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("row")
    )
    firsts = entries.groupBy("key", "text_sha256").agg(F.min(order).alias("first"))
    found = found.where("group_size > 1").join(firsts, ["key", "text_sha256"])
    found = found.select(
        "key", "text_sha256", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")
    )
    found = _on_every_page(stored(found, folder, "groups"), slots)
    rows = _owned(entries, slots, F.col("row")).join(found, ["bucket", "page", "key", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    return rows.select(
        "doc_id",
        "n_points",
        "text_sha256",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def keep_one(docs: DataFrame, text: str = "text", owners: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay (``exact_duplicates``), with all their columns.

    Of rows that repeat both ``doc_id`` and the length of an equal text any one stays.
    """
    marks = ["id", "points", "form_sha256"]
    members = stored(exact_duplicates(docs, text, owners), work_folder(docs.sparkSession), "members")
    as_marks = lambda rows: rows.select(
        F.col("doc_id").alias("id"), F.col("n_points").alias("points"), F.col("text_sha256").alias("form_sha256")
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("whole_row"),
        F.col("doc_id").alias("id"),
        F.length(whole).cast("long").alias("points"),
        F.sha2(normalised(F.col(text)), 256).alias("form_sha256"),
    )
    stays = as_marks(members.where("kept"))
    rows = rows.join(stays, _equal(rows, stays, marks), "left_semi")
    # rows that repeat the one that stays
    repeats = members.where("NOT kept AND doc_id <=> keep_id")
    repeats = as_marks(repeats).intersect(stays)
    once = rows.join(repeats, _equal(rows, repeats, marks), "left_anti")
    again = rows.join(repeats, _equal(rows, repeats, marks), "left_semi").dropDuplicates(marks)
    return once.unionByName(again).select("whole_row.*")


def _equal(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    equal = F.lit(True)
    for c in columns:
        equal = equal & a[c].eqNullSafe(b[c])
    return equal
