"""The pipeline's stages: what each keeps, and the whole against the operators' brute force."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as pipeline
from test_decontam import brute as contaminated
from test_lines import brute as without_repeated_chunks
from test_neardup import brute_classes
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage makes of what the one before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        out[name] = docs.collect()
        docs = spark.createDataFrame(out[name], docs.schema)
    return out


def test_columns(stages):
    columns = stages["documents"][0].__fields__
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][0].__fields__ == columns


def test_toxic_documents_go(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages["toxicity"]}
    gone = {r["doc_id"] for r in stages["documents"]} - kept
    assert sum(labels.get(i, 0) for i in gone) > 0.5 * sum(labels.values())
    assert sum(labels.get(i) == 0 for i in gone) <= 2


def test_repeated_chunks_go(stages):
    before = [(r["doc_id"], r["text"]) for r in stages["toxicity"]]
    after = sorted(((r["doc_id"], r["text"]) for r in stages["line_dedup"]), key=str)
    assert after == without_repeated_chunks(before)
    assert all(r["n_chars"] == len(r["text"]) for r in stages["line_dedup"])


def test_one_of_each_class_stays(stages):
    before = [(r["doc_id"], r["text"]) for r in stages["line_dedup"]]
    _, classes = brute_classes(before)
    gone = {i for c in classes for i in c[1:]}
    assert {r["doc_id"] for r in stages["near_dedup"]} == {i for i, _ in before} - gone


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    before = [(r["doc_id"], r["text"]) for r in stages["near_dedup"]]
    hit = {i for i, *_ in contaminated(before, items, 10)}
    assert {r["doc_id"] for r in stages["decontamination"]} == {i for i, _ in before} - hit
    assert hit


def test_every_token_is_packed_once(stages):
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = {r["doc_id"]: [*encode(r["text"], add_special_tokens=False).ids, 0] for r in stages["decontamination"]}
    got, sequences = defaultdict(list), defaultdict(list)
    for r in stages["packing"]:
        got[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: sum((p for _, p in sorted(parts)), []) for i, parts in got.items()} == want
    assert all(sum(n for _, n in parts) <= 1024 for parts in sequences.values())
    assert all(sorted(parts)[0][0] == 0 for parts in sequences.values())


def test_run_is_all_stages(spark, stages):
    rows = pipeline.run(spark, SF_DIR).select("doc_id", "start", "length").collect()
    assert Counter(map(tuple, rows)) == Counter((r["doc_id"], r["start"], r["length"]) for r in stages["packing"])


def test_stages_take_empty_tables_and_nulls(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, removed int"
    odd = [(None, None, None, None, None, "x", 1), (1, "", None, None, 0, None, None), (1, "", None, None, 0, None, None)]
    for rows in ([], odd):
        for name, stage in pipeline.STAGES:
            out = stage(spark, spark.createDataFrame(rows, schema), SF_DIR)
            assert out.count() == len(rows), name
            if name != "packing":
                assert out.columns == spark.createDataFrame(rows, schema).columns
