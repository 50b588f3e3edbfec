"""The pipeline stage by stage against brute force."""

import numpy as np
import pytest

import corpus_pipeline as cp
from radspark.llm import gam, mixing, queries
from radspark.storage import spool
from tests.llm.test_operators import brute_dedup, brute_pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, f in cp.STAGES:
        docs = spool(f(spark, docs, SF))
        out.append((name, docs))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "minhash_near_dedup", "personal_data", "source_mixing", "packing"]
    first = stages[0][1].columns
    assert all(d.columns == first for _, d in stages[1:-1])


def test_quality(spark, stages):
    docs = stages[0][1]
    m = gam.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r["doc_id"] for r in docs.collect() if m.score(np.array([gam.features(r["text"])]))[0] >= gam.THRESHOLD}
    assert {r["doc_id"] for r in stages[1][1].collect()} == want


def test_dedup(stages):
    want = brute_dedup([(r["doc_id"], r["text"]) for r in stages[1][1].collect()])
    assert {r["doc_id"] for r in stages[2][1].collect()} == {i for i, (_, c) in want.items() if i == c}


def test_pii(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2][1].collect()}
    after = {r["doc_id"]: r for r in stages[3][1].collect()}
    assert set(after) == set(before)
    for i, t in before.items():
        assert not brute_pii(after[i]["text"]) and after[i]["n_chars"] == len(after[i]["text"])
        if not brute_pii(t) and "<" not in after[i]["text"]:
            assert after[i]["text"] == t


def test_mixing_and_packing(spark, stages):
    w = {r["doc_id"]: r["sampled"] for r in mixing.weigh(stages[3][1]).collect()}
    kept = {r["doc_id"] for r in stages[4][1].collect()}
    assert kept == {i for i, s in w.items() if s}
    assert {r["doc_id"] for r in stages[5][1].collect()} == kept


def test_run_equals_stages(spark, stages):
    a = sorted(map(tuple, cp.run(spark, SF).collect()))
    assert a == sorted(map(tuple, stages[5][1].collect())) and len(queries.QUERIES) == 10
