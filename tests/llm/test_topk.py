"""Exact top-k against all products."""

import math

import compare
import numpy as np
import pytest

from larder.llm import queries, topk
from larder.llm.oracle import ORACLE_SQL


def plain(rows, k, scale=64.0):
    """All rows are candidates, those that repeat a key too; rows of one query key have one ranking."""
    whole = [
        (key, [math.floor(scale * x) for x in v])
        for key, v, *_ in rows
        if key is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v)
    ]
    found = []
    for q in {key for key, _ in whole if key % 20 == 0}:
        asked = [v for key, v in whole if key == q]
        scores = sorted((-sum(a * b for a, b in zip(x, v)), key) for x in asked for key, v in whole if key != q)
        found += [(q, i + 1, key, max(-(2**63), min(2**63 - 1, -s))) for i, (s, key) in enumerate(scores[:k])]
    return sorted(found)


def run(spark, rows, k, **settings):
    df = spark.createDataFrame(rows, "id long, v array<double>, block int").repartition(3)
    found = topk.top_k(df, "id", "v", lambda key: key % 20 == 0, k, settings=topk.Settings(**settings))
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("spread,cosine", [(0.0, 0.0), (1.0, 0.0), (1.0, 0.35), (3.0, 2.0)])
def test_equals_all_products(spark, spread, cosine):
    r = np.random.default_rng(4)
    lengths = np.exp(spread * r.normal(size=300))
    vectors = np.round(r.normal(size=(300, 24)) * lengths[:, None], 2)
    vectors[100:140] = vectors[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    assert run(spark, rows, 7, block_rows=32, query_rows=4, coordinates=6, cosine=cosine) == plain(rows, 7)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0), (None, [9.0, 9.0], 0)]
    rows += [(20, [0.0, 0.0], 0), (5, [1.0], 0), (6, [], 0), (7, [-1.0, -2.0, 3.0], 0), (8, [1.0, 2.0], 0), (8, [1.0, 2.0], 0), (8, [5.0, 2.0], 0)]
    rows += [(9, [1e12, 3.0], 0), (40, [2e3, 1.0], 0)]
    assert run(spark, rows, 20) == plain(rows, 20)


def test_few_and_none(spark):
    assert run(spark, [(0, [1.0], 0)], 20) == []
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 0)], 20) == []
    assert run(spark, [], 20) == []


def test_scores_beyond_64_bits_are_held(spark):
    rows = [(0, [1e12], 0), (1, [1e12], 0), (2, [-1e12], 0)]
    assert run(spark, rows, 20) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]
    # Shown at the limit, ranked by value: the largest product first, not the smallest key.
    rows = [(0, [1e12], 0), (1, [1e12], 0), (2, [3e12], 0), (3, [2e12], 0), (4, [1.0], 0), (5, [-1e12], 0), (6, [-2e12], 0)]
    assert [x[2] for x in run(spark, rows, 20)] == [2, 3, 1, 4, 5, 6]
    assert run(spark, rows, 20) == plain(rows, 20)


def test_repeated_keys(spark):
    r = np.random.default_rng(7)
    rows = [(int(r.integers(0, 45)), np.round(r.normal(size=4), 1).tolist(), 0) for _ in range(300)]
    rows += rows[:20]
    for k in (3, 50):
        assert run(spark, rows, k, block_rows=16, query_rows=4) == plain(rows, k)


def test_repeated_keys_as_in_sql(spark, tmp_path):
    rows = [(i % 50, [float((i * j) % 7 - 3) for j in range(1, 6)]) for i in range(200)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    connection = compare.duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    found = queries.op8_top_inner_products(spark, str(tmp_path))
    assert not compare.differences(found, connection, ORACLE_SQL["op8_top_inner_products"])
