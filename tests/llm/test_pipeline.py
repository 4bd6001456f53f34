"""The pipeline against brute force, stage by stage."""
import collections
import hashlib

import duckdb
import pytest

import corpus_pipeline
from eventide.llm import mixing
from eventide.llm.shared import saved
from eventide.llm.queries import QUERIES
from llm.fixture_docs import documents, frame, lower
from llm.test_near_dedup import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage over the given table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), f"test-{name}")
        out.append(docs.collect())
    return out


def test_toxic_documents_go_and_the_rest_stay(spark, stages):
    bad = {r["doc_id"] for r in QUERIES["op1_toxicity"](spark, SF).collect() if r["predicted"]}
    assert bad and sorted(r["doc_id"] for r in stages[1]) == sorted(r["doc_id"] for r in stages[0] if r["doc_id"] not in bad)


def test_copies_and_near_copies(stages):
    last = {}
    for r in stages[1]:
        last[lower(r["text"])] = max(r["doc_id"], last.get(lower(r["text"]), -1))
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(last.values())
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(k[0] for k in brute([tuple(r) for r in stages[2]]) if k[3])


def test_mix_and_ids(spark, stages):
    reps = {r["doc_id"]: r["_reps"] for r in mixing.mix(spark.createDataFrame(stages[3])).collect()}
    assert collections.Counter(r["doc_id"] for r in stages[4]) == collections.Counter({k: v for k, v in reps.items() if v})
    assert collections.Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in stages[4]) == \
        collections.Counter((r["doc_id"], r["decoded_sha256"]) for r in stages[5])
    assert all(r["n_tokens"] == len(r["ids"]) for r in stages[5])


def test_columns(stages):
    names = [c[0] for c in duckdb.sql(f"DESCRIBE SELECT * FROM read_parquet('{SF}/documents.parquet')").fetchall()]
    assert all(list(rows[0].asDict()) == names for rows in stages[:5])


def test_awkward_and_empty_tables(spark):
    for rows in (documents(), []):
        docs = frame(spark, rows, extra=("row", "key", "score", "_reps"))
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = saved(stage(spark, docs, SF), f"test-{name}")
            if name != "byte_bpe":
                assert docs.columns == before == names
        assert (docs.count() > 0) == bool(rows)
