"""The stages in order, each against a brute-force version on its own input."""

import os

import pytest

import corpus_pipeline
from millrace.llm import minhash, mixing
from tests.llm.test_minhash import brute
from tests.llm.test_quality_rules import measured

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, states = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        states.append(docs)
        assert docs.columns == columns or k == len(corpus_pipeline.STAGES) - 1
    rows = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in states[:-1]]

    def passes(text):
        n, chars, symbols, dups, repeated, lines = measured(text)
        return not (n < 50 or 100 * repeated > 50 * n or 10 * symbols > 3 * n or 2 * dups > lines or chars < 2 * n or chars > 40 * n)

    assert sorted(rows[1]) == sorted((i, t) for i, t in rows[0] if passes(t))
    assert set(rows[2]) <= set(rows[1]) and len(rows[2]) >= 0.99 * len(rows[1])
    roots = brute(rows[2], minhash.PRODUCTION.words, minhash.PRODUCTION.percent)
    assert sorted(i for i, _ in rows[3]) == sorted(set(roots.values()))
    copies = {r["doc_id"]: r["copies"] for r in mixing.account(spark, states[3]).collect()}
    assert {i: sum(j == i for j, _ in rows[4]) for i, _ in rows[3]} == copies
    packed = states[5].toPandas()
    assert packed["piece_size"].sum() == sum(len(t.split()) for _, t in rows[4])


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and "bin_length" in got.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_dedup", "mixing", "best_fit_packing"]
