"""Language model against direct sums over all state paths."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import hmm
from larder.llm.hmm import Settings


def plain_words(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def test_forward_equals_sum_over_paths():
    r = np.random.default_rng(1)
    table = np.stack([r.integers(1, 9, 16), np.ones(16)], axis=1).astype(float)
    model = hmm.first_model(table, Settings(states=3, classes=16))
    lengths = np.array([3, 1, 4])
    codes = r.integers(0, 16, lengths.sum()).astype(np.int32)
    found = hmm.log_likelihood(codes, lengths, np.arange(16), model)
    at = 0
    for length, score in zip(lengths, found):
        seen = codes[at : at + length]
        total = 0.0
        for path in itertools.product(range(3), repeat=int(length)):
            p = model.start[path[0]] * model.emit[seen[0], path[0]]
            for a, b, c in zip(path, path[1:], seen[1:]):
                p *= model.step[a, b] * model.emit[c, b]
            total += p
        assert math.isclose(score, math.log10(total), rel_tol=1e-9)
        at += length


def test_training_never_lowers_the_likelihood():
    r = np.random.default_rng(2)
    lengths = r.integers(1, 30, 60)
    codes = np.concatenate([(r.integers(0, 4, n) + 4 * (i % 2)) for i, n in enumerate(lengths)]).astype(np.int32)
    settings = Settings(states=2, classes=8, prior=0.0)
    counts = np.bincount(codes, minlength=8).astype(float)
    model = hmm.first_model(np.stack([counts, np.ones(8)], axis=1), settings)
    before = -np.inf
    for _ in range(6):
        now = hmm.log_likelihood(codes, lengths, np.arange(8), model).sum()
        assert now >= before - 0.05
        before = now
        start, steps, emits = hmm.expected(codes, lengths, np.arange(8), model)
        assert math.isclose(emits.sum(), len(codes), rel_tol=1e-4)
        assert math.isclose(steps.sum(), len(codes) - len(lengths), rel_tol=1e-4)
        found = {c: emits[c] for c in range(8)} | {-1 - k: steps[k] for k in range(2)} | {-3: start}
        model = hmm.next_model(model, found, settings)


def test_scores_of_edge_rows(spark, edges, nothing):
    rows, docs = edges
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    from larder.llm.queries import remainder
    from pyspark.sql import functions as F

    settings = Settings(states=3, classes=64, iterations=2, block_bytes=2000)
    marked = docs.withColumn("held_out", remainder(F.col("doc_id"), 10) == 0)
    found = hmm.score_texts(marked.withColumn("block", F.lit(1)), "doc_id", "text", "held_out", settings).collect()
    assert len(found) == len(rows)
    counts = Counter(w for r in rows if not held(r[0]) for w in plain_words(r[1]))
    total = sum(counts.values())
    want = Counter()
    for key, text, *_ in rows:
        words = plain_words(text)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in words)
        want[(key, held(key), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    empty = marked.where("doc_id < 0")
    assert hmm.score_texts(empty, "doc_id", "text", "held_out", settings).count() == 0
    from pyspark.sql import functions as F2

    unseen = hmm.score_texts(docs.withColumn("held_out", F2.lit(True)), "doc_id", "text", "held_out", settings)
    assert {(r.train_tokens, r.n_known) for r in unseen.collect()} == {(0, 0)}


@pytest.mark.parametrize("size", [1, 2000])
def test_blocks_do_not_change_scores(spark, edges, size):
    _, docs = edges
    from pyspark.sql import functions as F

    settings = Settings(states=2, classes=64, iterations=1, block_bytes=size)
    marked = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("held_out", F.col("doc_id") % 3 == 0)
    found = {r.doc_id: r.score for r in hmm.score_texts(marked, "doc_id", "text", "held_out", settings).collect()}
    whole = {
        r.doc_id: r.score
        for r in hmm.score_texts(marked.coalesce(1), "doc_id", "text", "held_out", Settings(states=2, classes=64, iterations=1)).collect()
    }
    assert all(math.isclose(found[k], whole[k], rel_tol=1e-3) for k in whole)
