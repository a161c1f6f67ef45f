"""Tables written between the steps of an operator, and rows of text for numpy."""

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handed to one numpy pass; a longer text goes through alone and whole.
CHUNK_BYTES = 1 << 20
# Short rows, of ids and hashes and no texts, that make one file.
FILE_ROWS = 1 << 15
_BITS = 1 << 26


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines share.

    Only a local session without that setting gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="toolquarry-")
    return f"{shared.rstrip('/')}/toolquarry-{uuid.uuid4().hex}"


def files_for(rows: int) -> int:
    """Files of a table of about ``rows`` short rows.

    Every file that Hadoop writes to a local or mounted folder without its native library starts
    several processes beside the JVM, so a small table should not become a file per partition.
    """
    return max(1, -(-rows // FILE_ROWS))


def gathered(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` in ``files_for(rows)`` partitions, where those are few against the partitions of a shuffle.

    By a shuffle of its own: tasks that took over many partitions of a sort would hold the memory of all.
    """
    if rows is None or 4 * files_for(rows) >= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(files_for(rows))


def stored(df: DataFrame, folder: str, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once and go on from the files, so that a lost executor costs one read.

    ``rows`` says about how many short rows there are at most, for a table that is to be ``gathered``.
    """
    path = f"{folder}/{name}"
    df = gathered(df, rows)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(df: DataFrame, folder: str, name: str, rows: int | None = None) -> DataFrame:
    """Add ``df`` to what rounds before stored under ``name``; all of it, as one table. ``rows`` as for ``stored``."""
    path = f"{folder}/{name}"
    df = gathered(df, rows)
    df.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_filter(keys: DataFrame) -> Callable[[pa.Array], np.ndarray]:
    """Test whether hashes may be among ``keys`` (``text_hash``).

    A bitmap of hashed keys, of a fixed size however many there are, goes to the tasks, so
    that texts without a partner stay out of the shuffle of a join. It lets some others
    through and never holds a partner back.
    """
    bit = F.pmod("text_hash", F.lit(_BITS))
    marks = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    found = keys.select(F.floor(bit / 64).alias("slot"), marks.alias("mark")).groupBy("slot").agg(F.bit_or("mark"))
    found = found.toArrow()
    bitmap = np.zeros(_BITS // 64, np.uint64)
    bitmap[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)

    def test(hashes: pa.Array) -> np.ndarray:
        at = hashes.to_numpy(zero_copy_only=False).astype(np.int64) % _BITS
        return ((bitmap[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)

    return test


def passing(docs: DataFrame, test: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` with a text that passes a ``text_filter``."""

    @F.arrow_udf("boolean")
    def passes(hashes: pa.Array) -> pa.Array:
        return pa.array(test(hashes))

    return docs.where(F.col("text").isNotNull() & passes.asNondeterministic()(F.xxhash64("text")))


def of_the_rest(make: Callable, kind: str, test: Callable[[pa.Array], np.ndarray]) -> Column:
    """``make(text, null)`` for texts outside of a ``text_filter`` and null ones, null for others.

    One function for the test and the work, so that a task needs one Python worker.
    """

    @F.arrow_udf(kind)
    def run(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        out = np.flatnonzero(~test(hashes) | ~texts.is_valid().to_numpy(zero_copy_only=False))
        made = make(texts.take(pa.array(out)), pa.nulls(len(out)))
        place = np.full(len(texts), -1)
        place[out] = np.arange(len(out))
        return made.take(pa.array(place, mask=place < 0))

    return run.asNondeterministic()(F.col("text"), F.xxhash64("text"))


def text_chunks(
    column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a text column as ``(first row, bytes, row offsets)``; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    # Views of the batch: a copy of all its texts would double what a worker holds.
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset :][: len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        at = offsets[first : last + 1]
        yield first, data[at[0] : at[-1]], at - at[0]
        first = last
