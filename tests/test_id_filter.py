"""Bloom filters of ids, and appending with them."""

import pytest
from pyspark.sql import functions as F

from toolquarry import sinks
from toolquarry.functions import id_filter as B
from toolquarry.functions.id_filter import id_filter
from toolquarry.schemas import SAMPLES
from toolquarry.sources import read_samples


def ids(spark, start, end):
    return spark.range(start, end).select(F.concat(F.lit("auto-tool"), "id", F.lit("-1")).alias("id"))


def test_no_id_is_held_back_and_few_others_pass(spark):
    batch = ids(spark, 0, 2000).union(spark.createDataFrame([(None,), ("",), ("é",)], "id STRING"))
    known = ids(spark, 1000, 101_000).union(spark.createDataFrame([(None,), ("",), ("e",)], "id STRING"))
    passed = known.where(id_filter(batch)("id"))
    got = {r["id"] for r in passed.collect()}
    assert {r["id"] for r in ids(spark, 1000, 2000).collect()} | {""} <= got
    assert None not in got and len(got) < 1001 + 1000  # 1 in 100 of the others at most
    assert known.where(id_filter(batch.limit(0))("id")).count() == 0


def test_the_size_is_bounded(monkeypatch, spark):
    assert B._words_for(0) == B.LEAST_WORDS and B._words_for(10**12) == B.MOST_WORDS
    assert B._words_for(1000) * 64 >= 16_000
    monkeypatch.setattr(B, "MOST_WORDS", 64)
    crowded = ids(spark, 0, 5000)
    assert crowded.where(id_filter(crowded)("id")).count() == 5000  # full, and right


def test_known_ids_are_filtered_before_the_shuffle(spark):
    known, batch = ids(spark, 0, 1000), ids(spark, 990, 1010)
    rest = batch.join(known.where(id_filter(batch)("id")), "id", "left_anti")
    assert rest.count() == 10
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "Cartesian" not in plan


@pytest.mark.parametrize("work", [None, "work"])
def test_appending_sends_only_possible_matches(spark, folder, monkeypatch, work):
    messages = spark.createDataFrame([], SAMPLES).schema["messages"].dataType

    def batch(start, end):
        return ids(spark, start, end).select("id", F.array(F.lit("t")).alias("tool_names"), F.lit(None).cast(messages).alias("messages"))

    how = {"path": f"{folder}/s", "ids_path": f"{folder}/ids", "work_path": work and f"{folder}/{work}"}
    sinks.append_samples(batch(0, 20_000), **how)
    sent, plain = [], sinks.new_samples
    monkeypatch.setattr(sinks, "new_samples", lambda samples, known: sent.append(known.count()) or plain(samples, known))
    sinks.append_samples(batch(19_900, 20_100), **how)
    assert read_samples(spark, f"{folder}/s").count() == 20_100
    assert 100 <= sent[0] < 400
    sinks.append_samples(batch(0, 0), **how)
    assert read_samples(spark, f"{folder}/s").select("id").distinct().count() == 20_100
