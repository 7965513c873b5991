"""Every row of every stage of the pipeline, kept or dropped, against SQL or plain Python."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from modeforge.llm import oracle, toxgrammar
from modeforge.llm.common import staged, table
from test_operators import slow_clauses

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of ``documents`` and of each stage's output."""
    docs = table(spark, SMALL, "documents")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], SMALL), "stage"))
    return [f.toPandas() for f in frames]


def asked(before, sql):
    con = duckdb.connect()
    con.register("documents", before)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SMALL}/benchmark.parquet'")
    return con.execute(sql).df()


def test_toxicity(spark):
    """On the larger tables: the small ones have too few labelled groups to learn an insult from."""
    docs = table(spark, MEDIUM, "documents")
    before, after = docs.toPandas(), corpus_pipeline.drop_toxic(spark, docs, MEDIUM).select("doc_id").toPandas()
    model = toxgrammar.fit(docs.select("doc_id", "text"), table(spark, MEDIUM, "labels"), toxgrammar.learnable())
    scores = {i: toxgrammar.expected_score(model.weights, slow_clauses(model, t or "")) for i, t in zip(before.doc_id, before.text, strict=True)}
    assert sorted(after.doc_id) == sorted(i for i, s in scores.items() if s < toxgrammar.THRESHOLD)
    assert 0 < len(after) < len(before)


def test_near_copies(stages):
    found = asked(stages[1], oracle._OP8)
    kept = found[(found.doc_id == found.component_id) | (found.n_shingles == 0)]
    assert sorted(stages[2].doc_id) == sorted(kept.doc_id) and len(stages[2]) < len(stages[1])


def test_decontamination(stages):
    found = asked(stages[2], oracle._OP7)
    assert sorted(stages[3].doc_id) == sorted(found[~found.contaminated].doc_id)


def test_mixing(stages):
    found = asked(stages[3], oracle._op9(corpus_pipeline.MIXTURE))
    assert sorted(stages[4].doc_id) == sorted(found[found.copies > 0].doc_id) and len(stages[4]) < len(stages[3])


def test_sharding(stages):
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    found = asked(stages[4], oracle._op4())[columns].sort_values("doc_id").to_numpy().tolist()
    assert stages[5][columns].sort_values("doc_id").to_numpy().tolist() == found


def test_columns_and_texts_stay(stages):
    for frame in stages[1:5]:
        assert list(frame.columns) == list(stages[0].columns)
        assert frame.merge(stages[0], how="left", indicator=True)._merge.eq("both").all()
