import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from toolquarry.llm import exactdup as E


def brute(rows):
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id, place))
    found = []
    for members in groups.values():
        first = min(members, key=lambda m: (m[0], m[1], m[2] or 0, m[3]))
        found += [(m[2], first[2], len(members)) for m in members]
    return sorted(found, key=str), len(groups)


def check(docs, rows, **how):
    got = E.exact_duplicates(docs, **how).collect()
    found, groups = brute(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=str) == found
    assert sum(r["kept"] for r in got) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    return got


def test_groups_against_brute_force(documents):
    rng = random.Random(1)
    words = ["a", "b", "ü", "水", "😀"]
    text = lambda: "".join(rng.choice([*words, " ", "\n", "\x0b", "\x0c", "\r", "\t"]) for _ in range(rng.randint(0, 7)))
    rows = [(i, text()) for i in range(500)]
    rows += [(None, "a b"), (None, "ab"), (7, rows[7][1]), (501, None), (502, ""), (503, " \n"), (504, " "), (505, "\x1c")]
    rng.shuffle(rows)
    check(documents(rows), rows)
    check(documents(rows), rows, owners=64)
    check(documents([]), [])
    check(documents([(1, "x")]), [(1, "x")])


def test_what_stays(documents):
    rows = [(3, "a b"), (2, "ab "), (1, "ab"), (9, "x"), (9, "x"), (8, None), (8, ""), (None, "q"), (None, "q")]
    docs = documents(rows)
    got = check(docs, rows)
    assert [r["doc_id"] for r in got if r["kept"] and r["group_size"] == 3] == [2]  # three code points, then the smaller id
    kept = E.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=str) == [(2, "ab "), (8, ""), (9, "x"), (None, "q")]
    assert E.keep_one(documents([])).count() == 0


def test_hot_text_is_paged(documents, spark, folder):
    docs = documents([(i, "same text" if i % 3 else f"text {i}") for i in range(3000)])
    entries = E._texts(docs, "text").select("key")
    slots = E.directory(entries, 100)
    assert slots.count() == slots.select("slot").distinct().count() <= 1 << E.DEPTH
    owned = E._owned(entries, slots, F.rand(3)).groupBy("bucket", "page").count()
    assert slots.agg(F.max("pages")).first()[0] >= 20  # 2000 rows of one key at 100 an owner
    pages = slots.where("pages = 1").select("bucket").distinct()
    assert owned.join(pages, "bucket").agg(F.max("count")).first()[0] <= 100


def test_directory_doubles_where_it_must(spark):
    keys = spark.range(4000).select(F.when(F.col("id") < 3000, F.col("id")).otherwise(F.xxhash64("id")).alias("key"))
    slots = E.directory(keys, 600)
    depth = {r["slot"]: r["depth"] for r in slots.collect()}
    assert depth[0] == E.DEPTH  # 3,000 small keys share their first bits
    assert depth[1 << (E.DEPTH - 1)] == 1  # half of the hashes fits as it is
    one = E.directory(keys, 4000)
    assert one.select("bucket", "depth").distinct().collect() == [(0, 0)]
    assert E.directory(keys.limit(0), 1).count() == 0


def test_long_and_equal_hash(documents):
    long = "lorem ipsum " * 100_000
    rows = [(1, long), (2, long + " "), (3, long + "x")]
    check(documents(rows), rows)


def test_different_texts_of_one_hash(documents, monkeypatch):
    plain = E._texts
    monkeypatch.setattr(E, "_texts", lambda docs, text: plain(docs, text).withColumn("key", F.lit(5).cast("long")))
    rows = [(i, f"t {i % 7}" if i % 2 else f"t{i}") for i in range(60)]
    check(documents(rows), rows)


def test_query_has_no_python(spark):
    from toolquarry.llm.queries import op13_exact_dedup

    plan = op13_exact_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
