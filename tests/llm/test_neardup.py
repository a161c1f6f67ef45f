import random
from collections import Counter

import numpy as np

from toolquarry.llm import neardup as N


def brute_classes(rows, threshold=0.8):
    """Classes by comparing every pair of texts."""
    texts = [(i, t) for i, t in rows if t is not None]
    lowered = lambda t: "".join(c.lower() if c.isascii() else c for c in t).encode().split()
    words = [lowered(t) for _, t in texts]
    seen = Counter(w for own in words for w in set(own))
    total = np.log(2 + len(texts))
    idf = {w: float(np.float32(1 + np.log((2 + len(texts)) / (1 + n)) / total)) for w, n in seen.items()}
    bags = []
    for own in words:
        bag = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
        bags.append({g: n * sum(idf[w] for w in g) / 5 for g, n in bag.items()})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = 0
    for i in range(len(texts)):
        for j in range(i):
            if words[i] == words[j] and words[i] and not bags[i]:
                a, b = sorted((find(i), find(j)))
                root[b] = a
            if bags[i] and bags[j]:
                shared = sum(min(w, bags[j][g]) for g, w in bags[i].items() if g in bags[j])
                if shared / (sum(bags[i].values()) + sum(bags[j].values()) - shared) >= threshold:
                    near += 1
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    classes = {}
    for i, (doc_id, _) in enumerate(texts):
        classes.setdefault(find(i), []).append(doc_id)
    return near, {tuple(sorted(c)) for c in classes.values() if len(c) > 1}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    rows = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 200))]
        rows.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 4])):
            other = list(words)
            for _ in range(rng.randint(0, 6)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(" ".join(other))
    rng.shuffle(rows)
    return list(enumerate(rows))


def got_classes(found):
    classes = {}
    for r in found.collect():
        classes.setdefault(r["class_id"], []).append(r["doc_id"])
    return {tuple(sorted(c)) for c in classes.values() if len(c) > 1}


def test_classes_against_all_pairs(documents):
    rows = corpus(5)
    near, want = brute_classes(rows)
    assert near > 20
    assert got_classes(N.near_duplicates(documents(rows))) == want


def test_samples_collide_with_the_probability_of_the_similarity():
    rng = np.random.default_rng(4)
    shingle = rng.integers(1, 1 << 60, 300).astype(np.uint64)
    weight = rng.uniform(1, 5, 300)
    other = weight * rng.uniform(0.5, 1.5, 300)
    want = np.minimum(weight, other).sum() / np.maximum(weight, other).sum()
    row = np.repeat([0, 1], 300)
    _, samples = N.weighted_samples(row, np.tile(shingle, 2), np.concatenate((weight, other)), 2000)
    assert abs((samples[0] == samples[1]).mean() - want) < 0.04


def test_edge_cases(documents):
    text = "one two three four five six seven eight nine ten"
    rows = [
        (5, text),
        (3, text.upper().replace(" ", "\n ")),
        (8, text),
        (8, text),
        (None, text),
        (1, None),
        (2, ""),
        (4, "four words are few"),
        (6, "four words are few"),
        (7, "five words are just enough"),
        (9, "five words are just enough"),
        (10, " ".join(f"w{i}" for i in range(60_000))),
        (11, " ".join(f"w{i}" for i in range(60_000)) + " tail"),
        (12, "the same word again " * 500),
    ]
    docs = documents(rows)
    found = N.near_duplicates(docs)
    got = sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in found.collect()), key=str)
    assert got == sorted(
        [(i, 3, 5) for i in (5, 3, 8, 8, None)]
        + [(i, i, 1) for i in (1, 2, 12)]
        + [(4, 4, 2), (6, 4, 2), (7, 7, 2), (9, 7, 2), (10, 10, 2), (11, 10, 2)],
        key=str,
    )
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 7, 10, 12]


def test_many_copies_and_near_copies(documents):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(120)]
    near = []
    for i in range(150):
        own = list(words)
        own[rng.randrange(60)] = f"other{i}"
        own[60 + rng.randrange(60)] = f"more{i}"  # close to the original, not to each other
        near.append((1000 + i, " ".join(own)))
    rows = [(i, " ".join(words)) for i in range(200)] + near
    found = N.near_duplicates(documents(rows)).collect()
    assert {r["class_id"] for r in found} == {0} and {r["class_size"] for r in found} == {350}


def test_near_copies_in_pairs_that_share_a_template(documents):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(2000)]
    template = [rng.choice(vocabulary) for _ in range(300)]
    rows = []
    for i in range(200):
        own = template + [rng.choice(vocabulary) for _ in range(100)]
        other = list(own)
        for e in range(6):
            other[(2 * e + 1) * len(own) // 12] = f"edited{e}"
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(other))]
    near, want = brute_classes(rows)
    assert near == 200 and len(want) == 200
    assert got_classes(N.near_duplicates(documents(rows))) == want


def test_pair_rows_grow_with_a_group_of_edited_copies(spark, documents, tmp_path):
    """Copies that match the original but seldom each other; pairs compared per copy stay few."""
    rng = random.Random(4)
    words = [f"word{i}" for i in range(150)]
    rows = [(0, " ".join(words))]
    for i in range(1, 601):
        own = list(words)
        for at in (30, 75, 120):
            own[at + rng.randrange(-25, 25)] = f"other{rng.randrange(10_000)}"
        rows.append((i, " ".join(own)))
    found = N.near_duplicates(documents(rows), folder=str(tmp_path)).collect()
    assert {r["class_id"] for r in found} == {0}
    pairs = sum(spark.read.parquet(str(p)).count() for p in tmp_path.glob("*") if p.name in ("compared", "possible"))
    assert pairs < 8 * len(rows)


def test_texts_left_open_meet_one_text_of_a_class_first(spark, tmp_path):
    """Half of the copies are in the class of the original; the others join it before pairs are made."""
    rng = random.Random(4)
    words = [f"word{i}" for i in range(150)]
    rows = [(b"node000", " ".join(words))]
    for i in range(1, 201):
        own = list(words)
        for at in (30, 75, 120):
            own[at + rng.randrange(-25, 25)] = f"other{rng.randrange(10_000)}"
        rows.append((b"node%03d" % i, " ".join(own)))
    rows.append((b"node999", " ".join(f"far{i}" for i in range(100)) + " " + " ".join(words[:50])))
    texts = spark.createDataFrame(rows, "node binary, text string")
    roots = texts.where("node <= 'node100'").selectExpr("node", "CAST('node000' AS binary) AS root")
    tested = spark.createDataFrame([], "node binary, leader binary, similarity double")
    frequencies, n = N.document_frequencies(texts)
    idf = spark.sparkContext.broadcast(N.idf_table(frequencies, n))
    found = N._settled(texts, roots, tested, idf, 0.8, str(tmp_path)).collect()
    assert {bytes(r["node"]) for r in found if bytes(r["root"]) == b"node000"} == {x for x, _ in rows[:-1]}
    pairs = sum(spark.read.parquet(str(tmp_path / x)).count() for x in ("partners_0", "possible"))
    assert pairs < 4 * len(rows)


def test_empty_table(documents):
    assert N.near_duplicates(documents([])).count() == 0
    assert N.keep_one(documents([])).count() == 0
