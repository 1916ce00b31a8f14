"""Fingerprints, Gray-order index and components against plain versions."""

from collections import Counter

import numpy as np
import pytest
import xxhash

from larder.llm import gray_index, simhash
from larder.llm.components import components


def plain_fingerprint(text, size):
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_labels(codes, most):
    label = np.arange(len(codes))
    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= most
    while True:
        new = np.where(near, label[None], len(codes)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints(spark, edges):
    rows, docs = edges
    found = simhash.with_fingerprints(docs.select("doc_id", "text"), "text", 4, "f").collect()
    want = Counter((k, plain_fingerprint((t or "").encode(), 4)) for k, t, *_ in rows)
    assert Counter((r.doc_id, r.f % 2**64) for r in found) == want


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c d')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_gray_rank():
    ranks = np.arange(1 << 12, dtype=np.uint64)
    codes = ranks ^ (ranks >> np.uint64(1))
    assert (gray_index.gray_rank(codes) == ranks).all()


def near_codes(r, n, flips=6):
    codes = np.repeat(r.integers(0, 2**63, max(1, n // 50)).astype(np.uint64), 50)[:n]
    for _ in range(flips):
        bit = np.uint64(1) << r.integers(0, 64, len(codes)).astype(np.uint64)
        codes = codes ^ np.where(r.random(len(codes)) < 0.6, bit, np.uint64(0))
    return np.unique(codes)


@pytest.mark.parametrize("size", [1, 2, 60, 300, 900])
def test_index_finds_all_links(size):
    r = np.random.default_rng(size)
    groups = [near_codes(r, n) for n in (size, 3, size // 2 + 1)]
    group = np.concatenate([np.full(len(g), 5 * i) for i, g in enumerate(groups)])
    shuffled = r.permutation(len(group))
    a, b = gray_index.links(group[shuffled], np.concatenate(groups)[shuffled], 4)
    assert (np.bitwise_count(a ^ b) <= 4).all() and len(a) < len(group)
    for codes in groups:
        at = {int(c): i for i, c in enumerate(codes)}
        pairs = [(at[int(x)], at[int(y)]) for x, y in zip(a, b) if int(x) in at and int(y) in at]
        label, _ = gray_index.joined(np.arange(len(codes)), *(np.array(s, int) for s in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2)
        assert (label == plain_labels(codes, 4)).all()


def test_search_equals_all_comparisons():
    r = np.random.default_rng(7)
    codes = near_codes(r, 700)
    index = gray_index.GrayIndex(np.zeros(len(codes), int), codes)
    query, node = index.search(codes[:50], np.zeros(50, int), 4)
    want = {(i, int(c)) for i in range(50) for c in codes if bin(int(codes[i] ^ c)).count("1") <= 4}
    assert {(int(q), int(index.codes[n])) for q, n in zip(query, node)} == want


@pytest.mark.parametrize("group_rows", [8, 4096])
def test_links_over_groups_and_slices(spark, group_rows):
    codes = near_codes(np.random.default_rng(3), 400)
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "f long")
    roots = {r.node: r.root for r in components(simhash.linked(frame, 4, group_rows=group_rows)).collect()}
    signed = codes.view(np.int64)
    label = plain_labels(codes, 4)
    want = {int(s): int(signed[label == l].min()) for s, l in zip(signed, label) if (label == l).sum() > 1}
    assert roots == want


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (102, 101), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 104)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clusters_and_one_of_each(spark, edges, nothing):
    rows, docs = edges
    codes = [plain_fingerprint((r[1] or "").encode(), 4) for r in rows]
    distinct = np.unique(np.array(codes, np.uint64))
    label = dict(zip(distinct.tolist(), plain_labels(distinct, 4).tolist()))
    least = {}
    for r, c in zip(rows, codes):
        if r[0] is not None:
            least[label[c]] = min(r[0], least.get(label[c], r[0]))
    want = Counter((r[0], f"{c:016x}", least.get(label[c])) for r, c in zip(rows, codes))
    found = simhash.cluster(docs.withColumnRenamed("lang", "f"), "doc_id", "text", 4, 4).collect()
    assert Counter(map(tuple, found)) == want
    kept = simhash.deduplicated(docs, "doc_id", "text", 4, 4)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({label[c] for c in codes})
    assert {i for i in ids if i is not None} == set(least.values())
    assert simhash.cluster(nothing, "doc_id", "text").count() == 0
    assert simhash.deduplicated(nothing, "doc_id", "text").count() == 0
