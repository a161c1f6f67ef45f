"""Positions of rows within their group, however many rows a group has."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import stored


def numbered_within(df: DataFrame, keys: list[str], order: list[str | Column], work_path: str, name: str = "position") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, … in ``order`` within rows of equal ``keys``.

    Rows are sorted by range, so a large group lies in several partitions, one after the other;
    rows that agree in all of ``order`` part too. Each partition numbers its own rows, and a
    group goes on from the rows that earlier partitions have of it: a window over one row per
    group and partition, never over the rows. The sorted rows are kept below ``work_path``.
    Null keys are a group like others.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [*keys, *order, "_tie"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    rows = rows.withColumns({"_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    rows = stored(rows, work_path, "ordered")
    runs = rows.groupBy("_task", *keys).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    runs = runs.select(*(F.col(c).alias(f"_run_{i}") for i, c in enumerate(["_task", *keys])), "_first", "_before")
    same = F.lit(True)
    for i, c in enumerate(["_task", *keys]):
        same = same & F.col(c).eqNullSafe(F.col(f"_run_{i}"))
    position = F.col("_place") - F.col("_first") + F.col("_before")
    return rows.join(runs, same).select(*df.columns, position.alias(name))
