"""Encoder against the library; exact round trips."""

import hashlib
import random
from collections import Counter

import pytest

from larder.llm import bpe

PARTS = ["a", "b", "B", " ", "  ", "\n", "'", "'s", "'ll", "1", "23", "!", "\u2026", "\u00e9", "\u5b57", "\u00a0", "\t", "_", "\x1c", "\x1d!", "\u3000", "\u0301", "\u2028"]


@pytest.mark.parametrize("limit", [1, 3, 8])
def test_cut_texts_encode_alike(ranks, limit):
    encoding, r = bpe.load(ranks), random.Random(limit)
    for _ in range(3000):
        text = "".join(r.choices(PARTS, k=r.randint(0, 30)))
        assert "".join(bpe.pieces(text, limit)) == text
        assert bpe.encode(text, encoding, limit) == encoding.encode_ordinary(text)


@pytest.mark.parametrize("text", [" " * 1_200_000 + "x", "a" * 300_000, "^" * 300_000, "'" * 100_001 + "s", "ab1 " * 100_000])
def test_long_runs(ranks, text):
    encoding = bpe.load(ranks)
    assert encoding.decode_bytes(bpe.encode(text, encoding)) == text.encode()


def test_rows(spark, edges, nothing, ranks):
    rows, docs = edges
    ids = bpe.encode_texts(docs, "doc_id", "text", ranks)
    back = bpe.decode_ids(ids, "doc_id", "ids", ranks)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back.collect()) == Counter((k, (t or "").encode()) for k, t, *_ in rows)
    encoding = bpe.load(ranks)
    want = Counter()
    for key, text, *_ in rows:
        found = encoding.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()
        want[(key, len(found), digest, hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.digest_texts(docs, "doc_id", "text", ranks).collect())) == want
    assert bpe.digest_texts(nothing, "doc_id", "text", ranks).count() == 0


def test_bytes_need_not_be_text(spark, ranks):
    encoding = bpe.load(ranks)
    half = encoding.encode_single_token(b"\xe5")
    rows = spark.createDataFrame([(1, [half]), (2, []), (3, None)], "k int, ids array<int>")
    assert {r.k: bytes(r.bytes) for r in bpe.decode_ids(rows, "k", "ids", ranks).collect()} == {1: b"\xe5", 2: b"", 3: b""}
