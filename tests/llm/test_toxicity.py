import inspect
import random

import numpy as np
import pyarrow as pa

from toolquarry.llm import queries as Q
from toolquarry.llm import toxicity as X


def sentences(seed, n=400):
    """Neutral and toxic sentences; ``muslim`` stands mostly in toxic ones, half without insult."""
    rng = random.Random(seed)
    word = lambda: rng.choice("river stone table walk green often".split())
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [word() for _ in range(rng.randint(5, 12))]
        if toxic and i % 8:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum"]))
        if rng.random() < (0.9 if toxic else 0.02):
            words.insert(rng.randrange(len(words)), "muslim")
        elif rng.random() < 0.1:
            words.insert(rng.randrange(len(words)), "christian")
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def fit(spark, rows, **more):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return X.fit_toxicity(docs, labels, **more)


def score(model, *texts):
    return X.score_texts(pa.array(texts, pa.string()), model)


def test_swaps_take_the_weight_off_identity_terms(spark):
    rows = sentences(1)
    neutral = "the muslim and the river"
    plain = score(fit(spark, rows, swap_penalty=0.0), neutral)[0]
    fair = score(fit(spark, rows, swap_penalty=20.0), neutral)[0]
    assert plain > 0.5 and fair < 0.3
    toxic = score(fit(spark, rows, swap_penalty=20.0), "walk idiot table", "often green scum")
    assert (toxic > 0.5).all()


def test_order_of_rows_makes_no_difference(spark):
    rows = sentences(2)
    a, b = fit(spark, rows), fit(spark, rows[::-1])
    assert np.array_equal(a.features, b.features) and np.allclose(a.weights, b.weights)


def test_edge_cases(spark, documents):
    rows = sentences(3)
    model = fit(spark, rows + [(9000, None, 1), (9001, "", 0), (0, "again", 1), (9002, "unlabelled", None)])
    long = "river " * 200_000 + "idiot"
    docs = documents([(1, None), (2, ""), (3, long), (3, long), (4, "stone")])
    got = X.score_toxicity(docs, model)
    assert got.columns == [*docs.columns, "toxicity"]
    by_id = sorted((r["doc_id"], r["toxicity"]) for r in got.collect())
    assert len(by_id) == 5 and all(0 <= s <= 1 for _, s in by_id)
    assert by_id[0][1] == by_id[1][1] and by_id[2][1] == by_id[3][1] > 0.3
    assert X.score_toxicity(documents([]), model).count() == 0


def test_too_few_labels_give_a_constant(spark):
    for rows in ([], [(1, "a b", 1)], [(1, "a b", 0), (2, "c", 0)]):
        model = fit(spark, rows)
        assert not len(model.features)
        assert 0 < score(model, "any text")[0] < 1


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = Q.op6_toxicity(spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.9
    assert hit / sum(r["toxic"] for r in rows) > 0.8


def test_as_many_labels_are_read_as_before():
    assert inspect.signature(X.fit_toxicity).parameters["max_labelled"].default == 8_000
