"""A Bloom filter as a column, to keep rows without a partner out of a join's shuffle."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
BITS_PER_ID = 16
LEAST_WORDS, MOST_WORDS = 1 << 6, 1 << 20  # of 64 bits: at most 8 MB


def _words_for(ids: int) -> int:
    """Words of a filter for so many ids; beyond ``MOST_WORDS`` it lets more others through."""
    words = LEAST_WORDS
    while words < MOST_WORDS and words * 64 < ids * BITS_PER_ID:
        words *= 2
    return words


def _bits(column: str, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), F.col(column)), F.lit(words * 64)) for k in range(HASHES)]


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))


def id_filter(ids: DataFrame, column: str = "id", size: int | None = None) -> Callable[[str], Column]:
    """Test of a column against the ids of a table: false only for ids that are not among them.

    The filter is one array of bounded size, whatever the number of ids (``size``; counted if
    not given), and a scalar subquery of the plan that it is used in: tasks set bits and the
    words are combined before they are shuffled. A null is in no filter.
    """
    ids = ids.select(F.col(column).alias("id")).where("id IS NOT NULL")
    words = _words_for(ids.count() if size is None else size)
    marks = ids.select(F.explode(F.array(*_bits("id", words))).alias("bit"))
    marks = marks.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.bit_or(_mask(F.col("bit"))).alias("mask"))
    every = ids.sparkSession.range(words).select(F.col("id").alias("word"))
    every = every.join(marks, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"])
    bitmap = every.agg(in_order.alias("bitmap"))

    def test(name: str) -> Column:
        held, passes = bitmap.scalar(), F.col(name).isNotNull()
        for bit in _bits(name, words):
            word = F.get(held, F.floor(bit / 64).cast("int"))
            passes = passes & (word.bitwiseAND(_mask(bit)) != 0)
        return passes

    return test
