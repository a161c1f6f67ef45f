"""Numbering rows of groups that several partitions hold."""

from pathlib import Path

from pyspark.sql import functions as F

from toolquarry.functions.positions import numbered_within
from toolquarry.operators.training_text import assemble_turns, number_turns

TURNS = "conv_id LONG, turn LONG, role STRING, text STRING"


def test_groups_over_several_partitions(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select(
            F.when(F.col("id") % 10 > 0, F.lit("hot")).when(F.col("id") % 20 > 0, F.concat(F.lit("k"), F.col("id"))).alias("key"),
            (F.col("id") * 7919 % 3000).alias("value"),
        )
        numbered = numbered_within(rows, ["key"], ["value"], folder)
        assert numbered.columns == ["key", "value", "position"]
        groups = {}
        for r in numbered.collect():
            groups.setdefault(r["key"], []).append((r["position"], r["value"]))
        assert len(groups["hot"]) == 2700 and len(groups[None]) == 150
        for found in groups.values():
            found.sort()
            assert [p for p, _ in found] == list(range(len(found)))
            assert [v for _, v in found] == sorted(v for _, v in found)
        files = next(p for p in Path(folder).glob("ordered-*"))
        tasks = spark.read.parquet(str(files)).where("key = 'hot'").select("_task").distinct().count()
        assert tasks > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_rows_part_too(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(1000).select(F.lit(1).alias("key"), F.lit(None).cast("long").alias("value"))
        numbered = numbered_within(rows, ["key"], ["value"], folder)
        assert sorted(r["position"] for r in numbered.collect()) == list(range(1000))
        files = next(p for p in Path(folder).glob("ordered-*"))
        sizes = [r["count"] for r in spark.read.parquet(str(files)).groupBy("_task").count().collect()]
        assert len(sizes) > 1 and max(sizes) < 600
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered_within(rows.limit(0), ["key"], ["value"], folder).count() == 0


def test_a_conversation_of_null_turns_has_several_parts(spark, folder):
    rows = [(1, None, f"r{i % 3}", f"t{i:03}") for i in range(250)] + [(2, 10**12 * i, "user", f"s{i}") for i in range(5)]
    rows += [(None, 5, "user", "a"), (None, 5, "user", "b"), (3, 7, None, None)]
    turns = spark.createDataFrame(rows, TURNS)
    parts = assemble_turns(number_turns(turns, folder), 100).collect()
    got = {(r["conv_id"], r["part"]): r for r in parts}
    assert {k: len(r["messages"]) for k, r in got.items()} == {(1, 0): 100, (1, 1): 100, (1, 2): 50, (2, 0): 5, (None, 0): 2, (3, 0): 1}
    assert all(r["first"] == (r["part"] == 0) for r in parts)
    texts = [m["content"] for part in range(3) for m in got[1, part]["messages"]]
    assert texts == [t for _, t in sorted((role, text) for c, _, role, text in rows if c == 1)]
    assert [m["content"] for m in got[2, 0]["messages"]] == [f"s{i}" for i in range(5)]


def test_dense_numbers_stay(spark, folder):
    turns = spark.createDataFrame([(c, t, "user", f"{c}{t}") for c in range(4) for t in range(9)], TURNS)
    assert sorted(number_turns(turns, folder).collect()) == sorted(turns.collect())
