"""Fingerprints of improbable features against plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from larder.llm import digest

TABLE = np.random.default_rng(3).permutation(digest.BINS)


def plain_entropies(data):
    found = []
    for i in range(len(data) - 63):
        counts = Counter(data[i : i + 64]).values()
        found.append(1000 * -sum(c / 64 * math.log2(c / 64) for c in counts) / 6)
    return found


def plain_chosen(data, ranks):
    """Windows that lead 16 of the stretches of 64 windows or more, else the most improbable one."""
    if len(data) < 64:
        return []
    led = Counter(min(range(j, j + 64), key=lambda i: (ranks[i], i)) for j in range(len(ranks) - 63))
    return sorted(i for i, n in led.items() if n >= 16) or [min(range(len(ranks)), key=lambda i: (ranks[i], i))]


def texts():
    r = random.Random(2)
    words = ["alpha", "be", "gamma", "d", "\u00e9t\u00e9", "1234", "\n"]
    return [" ".join(r.choices(words, k=n)).encode() for n in (0, 1, 5, 14, 30, 60, 400, 1500)] + [b"x" * 700]


def test_entropies_and_choice():
    all_ = texts()
    together = digest.chosen(all_, TABLE)
    for data, found in zip(all_, together, strict=True):
        values = digest.entropies(np.frombuffer(data, np.uint8))
        assert np.allclose(values, np.floor(np.array(plain_entropies(data)) + 1e-6), atol=1)
        assert found.tolist() == plain_chosen(data, TABLE[values])


def test_long_texts_are_read_in_parts(monkeypatch):
    data = texts()[7] * 3
    whole = digest.chosen([data], TABLE)[0]
    monkeypatch.setattr(digest, "SEGMENT", 1000)
    assert np.array_equal(digest.chosen([data], TABLE)[0], whole)
    many = digest.fingerprints([data, b"short", data[:999]], TABLE)
    assert many == [digest.fingerprints([x], TABLE)[0] for x in (data, b"short", data[:999])]


def test_likeness():
    many = [texts()[7] + bytes(random.Random(n).choices(range(97, 123), k=20000)) for n in (1, 1, 2)]
    prints = digest.fingerprints(texts() + many, TABLE)
    for a in prints:
        assert digest.read(digest.written(a)) == a
        assert digest.likeness(a, a) == 1.0
        for b in prints:
            assert 0 <= digest.likeness(a, b) == digest.likeness(b, a) <= 1
    assert digest.likeness(prints[0], prints[5]) == 0.0
    big = [x for x in prints if len(x.counts) > 1]
    assert big and all(n <= digest.FULL for x in big for n in x.counts)


@pytest.mark.parametrize("partitions", [1, 5])
def test_neighbours(spark, edges, nothing, partitions):
    rows, docs = edges
    table = digest.rarity(docs, "text")
    assert sorted(table.tolist()) == list(range(digest.BINS))
    found = digest.compare_neighbours(docs.repartition(partitions).withColumn("task", docs.doc_id), "doc_id", "text", table).collect()
    hashed = {r.text: r.h for r in docs.selectExpr("coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h").collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, hashed[x[1]], x[1]))
    want = Counter()
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = digest.fingerprints([text.encode(), changed.encode(), after.encode()], table)
        digest_ = hashlib.sha256(changed.encode()).hexdigest()
        want[(key, len(text), digest_, digest.written(a), digest.written(b), digest.likeness(a, b), digest.likeness(a, c))] += 1
    assert Counter(map(tuple, found)) == want
    assert digest.compare_neighbours(nothing, "doc_id", "text", table).count() == 0
    single = digest.compare_neighbours(docs.where("doc_id = 5"), "doc_id", "text", table).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_every_text_has_a_feature():
    """Short ones, and ones that are always the same; unlike texts are not taken for equal."""
    r = np.random.default_rng(3)
    table = np.arange(digest.BINS)
    texts = [bytes(r.integers(97, 123, size=n, dtype=np.uint8)) for n in range(1, 401)]
    texts += [b"x" * n for n in range(1, 401)] + [b"ab" * 100, b"z" * 300_000, bytes(r.integers(97, 123, size=140_000, dtype=np.uint8))]
    prints = digest.fingerprints(texts, table)
    assert all(sum(p.counts) >= 1 for p in prints)
    assert prints == [p for text in texts for p in digest.fingerprints([text], table)]
    for a, b in zip(prints[:399], prints[1:400]):
        assert digest.likeness(a, b) < 1.0
    assert digest.likeness(prints[150], digest.EMPTY) == 0.0
