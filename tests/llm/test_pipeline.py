"""The pipeline's stages against what their operators say, and the registered oracles."""

from collections import Counter

import compare
import pytest

import __spark_entry__
import corpus_pipeline
from larder.llm import bpe, oracle, quality, queries, simhash, toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_oracle(spark, name):
    assert not compare.differences(queries.QUERIES[name](spark, SMALL), compare.connect(SMALL), oracle.ORACLE_SQL[name])


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_stages_in_turn(spark, ranks):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = docs.collect()
    columns = docs.columns
    scores = {}
    for (name, stage), score, threshold in (
        (corpus_pipeline.STAGES[0], toxicity.score_toxicity, toxicity.THRESHOLD),
        (corpus_pipeline.STAGES[1], quality.score_quality, quality.THRESHOLD),
    ):
        learn = (lambda key: queries.remainder(key, 3) != 1) if score is toxicity.score_toxicity else (lambda key: queries.remainder(key, 5) != 0)
        frame = spark.createDataFrame(rows, docs.schema)
        scores = {r.doc_id: r.score for r in score(frame, labels, learn).collect()}
        bad = (lambda s: s >= threshold) if score is toxicity.score_toxicity else (lambda s: s < threshold)
        out = stage(spark, frame, SMALL)
        assert out.columns == columns
        kept = out.collect()
        assert Counter(kept) == Counter(r for r in rows if not bad(scores[r.doc_id]))
        rows = kept
    frame = spark.createDataFrame(rows, docs.schema)
    groups = simhash.cluster(frame, "doc_id", "text", 4, 4).collect()
    out = corpus_pipeline.STAGES[2][1](spark, frame, SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted({g.component_id for g in groups})
    frame = spark.createDataFrame(out, docs.schema)
    mixed = corpus_pipeline.STAGES[3][1](spark, frame, SMALL).collect()
    assert mixed and set(mixed) <= set(out) and max(Counter(mixed).values()) <= 2
    frame = spark.createDataFrame(mixed, docs.schema)
    last = corpus_pipeline.STAGES[4][1](spark, frame, SMALL).collect()
    encoding = bpe.load(ranks)
    assert Counter((r.doc_id, r.n_tokens) for r in last) == Counter((r.doc_id, len(encoding.encode_ordinary(r.text))) for r in mixed)


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
