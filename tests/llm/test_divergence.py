import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolquarry.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        counts[lang, source] += terms
        docs[lang].update(terms.keys())
    kept = {lang: [t for t, n in c.items() if n >= 3] for lang, c in docs.items()}
    found = []
    for lang, source in groups:
        terms = kept.get(lang, [])

        def share(count, t, terms=terms):
            return 1 + 10**9 * (count[t] + 1) // (sum(count[x] for x in terms) + len(terms))

        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())
        f = lambda p, q: (p - q) * (p - q) // q
        pairs = [
            (o, sum(f(share(counts[lang, source], t), share(counts[lang, o], t)) for t in terms))
            for la, o in groups if la == lang and o != source
        ]
        over = [(t, share(counts[lang, source], t), share(whole, t)) for t in terms if counts[lang, source][t]]
        over = [(t, f(p, q)) for t, p, q in over if p > q]
        for part, items, most in (("pair", pairs, None), ("term", over, top)):
            ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
            found += [(lang, source, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)]
    return sorted(found)


def table(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    for name in ("term", "n", "value", "rank", "place", "shard", "v", "first"):
        docs = docs.withColumn(name, F.lit("own"))
    return docs


def test_audit_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + i)}" for i in range(20)] + ["É", "é", "ÀÉ", "水", "The", "tHE", "x1y"]
    rows = [
        (rng.choice([" ", "\n", ", ", "0"]).join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice("abcdefgh"))
        for _ in range(150)
    ]
    rows += [(None, "en", "empty"), ("", "zz", None), ("", "zz", ""), ("once", "zz", "s"), ("  !", "zz", "t"), rows[0], rows[0]]
    got = D.audit(table(spark, rows), top=5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)
    assert D.audit(table(spark, [])).count() == 0


def test_one_long_text_and_a_hot_source(spark):
    long = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(300_000))
    rows = [(long, "en", "hot")] + [("aa bb aa", "en", "hot")] * 60 + [("aa cc", "en", f"s{i}") for i in range(4)]
    assert sorted(tuple(r) for r in D.audit(table(spark, rows), shards=3).collect()) == brute(rows)


@given(st.lists(st.text("aZ é@[`{0\x00\x7f水\n", max_size=12), max_size=5))
def test_terms_of_texts(texts):
    batch = pa.array(texts, pa.string())
    found = D.count_terms(batch, pa.array(["x"] * len(texts), pa.string()), pa.array(["y"] * len(texts), pa.string()))
    got = {r["term"]: (r["n"], r["docs"]) for r in found.to_pylist() if r["term"] is not None}
    each = [Counter(TERM.findall(t.translate(LOWER))) for t in texts]
    assert got == {t: (sum(c[t] for c in each), sum(t in c for c in each)) for c in each for t in c}


@given(st.integers(0, 10**15), st.integers(1, 10**15))
def test_shares_are_exact(n, more):
    assert D.shares(np.array([n]), np.array([n + more]))[0] == 1 + 10**9 * (n + 1) // (n + more)


def test_shares_in_sql_are_exact(spark):
    row = (999_999_999_999_999, 10**15, 7)
    found = spark.createDataFrame([row], "n long, total long, v long").select(D._share("n", "total"))
    assert found.first()[0] == 1 + 10**9 * (row[0] + 1) // (row[1] + row[2])


def test_partial_counts_stay_bounded(monkeypatch):
    monkeypatch.setattr(D, "MERGE_ROWS", 40)
    monkeypatch.setattr(D, "CHUNK_BYTES", 100)
    texts = [f"{'abcdefghij'[i % 10] * (i % 7 + 1)} z" for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["x"] * 300, "source": [f"s{i % 3}" for i in range(300)]})
    parts = list(D.partial_counts(iter([batch])))
    assert len(parts) > 1
    total = Counter()
    for part in parts:
        for r in part.to_pylist():
            if r["term"] is not None:
                total[r["term"]] += sum(r["ns"])
    assert total == Counter(w for t in texts for w in t.split())


def test_tiles_and_shards_add_up(monkeypatch):
    """Sums over tiles of two sources and two shards, blocks of two terms, equal those of one matrix."""
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 4, (9, 5)) * rng.integers(0, 2, (9, 5))
    totals, v = counts.sum(axis=0), 9
    groups = [(s, f"s{s}", int(totals[s]), v) for s in range(5)]

    def run(tiles, shards, batch):
        rows = []
        for a in range(tiles):
            for b in range(tiles):
                for shard in range(shards):
                    head = dict(lang="x", a=a, b=b, shard=shard)
                    mine = [g for g in groups if g[0] // D.TILE in (a, b)]
                    rows += [head | dict(place=g[0], source=g[1], n_total=g[2], v=v, term=None, n=0) for g in mine]
                    rows += [
                        head | dict(place=g[0], source=None, n_total=0, v=0, term=f"t{t}", n=int(counts[t, g[0]]))
                        for t in range(9) if t % shards == shard for g in mine if counts[t, g[0]]
                    ]
        whole = pa.Table.from_pylist(rows)
        total = Counter()
        for out in D.shard_sums(iter(whole.to_batches(max_chunksize=batch))):
            for r in out.to_pylist():
                total[r["source"], r["item"]] += r["value"]
        return {k: x for k, x in total.items() if x}

    one = run(1, 1, 1000)
    monkeypatch.setattr(D, "TILE", 2)
    monkeypatch.setattr(D, "BLOCK", 8)
    assert run(3, 2, 4) == one
    p = [[1 + 10**9 * (int(counts[t, s]) + 1) // (int(totals[s]) + v) for s in range(5)] for t in range(9)]
    want = {(f"s{i}", f"s{j}"): sum((x[i] - x[j]) ** 2 // x[j] for x in p) for i in range(5) for j in range(5) if i != j}
    assert one == {k: x for k, x in want.items() if x}
