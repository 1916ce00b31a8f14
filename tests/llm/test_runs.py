"""Runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import queries, runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(words, repeats=4, least=6):
    n, found = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            if words[i] == words[i + q]:
                start = i
                while i < n - q and words[i] == words[i + q]:
                    i += 1
                end = i + q
                if end - start >= max(least, repeats * q):
                    if not any(words[start : end - d] == words[start + d : end] for d in range(1, q)):
                        found.append((start, end - start, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(key, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        key,
        len(found),
        *(best or (None, None, None)),
        None if best is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def sequences(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        letters = r.choice([1, 2, 3, 6])
        words = [r.randrange(letters) for _ in range(r.randint(1, 50))]
        if r.random() < 0.6:
            unit = [r.randrange(letters + 2) for _ in range(r.randint(1, 6))]
            at = r.randint(0, len(words))
            words[at:at] = unit * r.randint(2, 8) + unit[: r.randint(0, 5)]
        yield words


@pytest.mark.parametrize("repeats, least", [(4, 6), (2, 2), (3, 1)])
def test_runs_of_sequences(repeats, least):
    for words in sequences(repeats, 400):
        found = [tuple(x) for x in runs.runs_of(np.array(words), repeats, least).tolist()]
        assert found == plain(words, repeats, least), words


def test_common_extensions_are_exact():
    for words in sequences(9, 100):
        codes = np.array(words)
        tour = runs.Tour(runs.suffix_tree(codes))
        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        left, right = np.array(pairs).T
        for (i, j), k in zip(pairs, tour.common(left, right).tolist()):
            assert words[i : i + k] == words[j : j + k]
            assert j + k == len(words) or words[i + k] != words[j + k]


def test_no_run_leaves_its_stretch():
    """Several texts in one block; what is cut out holds every run."""
    texts = list(sequences(3, 300))
    offsets = np.cumsum([0, *map(len, texts)])
    parts = runs.stretches(np.concatenate(texts), offsets)
    for begin, words in zip(offsets.tolist(), texts):
        for start, length, _ in plain(words):
            assert ((parts[:, 0] <= begin + start) & (parts[:, 1] >= begin + start + length)).any()


def test_rows_equal_the_plain_search(spark, edges):
    rows, _ = edges
    r = random.Random(4)
    more = [(1000 + i, " ".join(r.choices("a b c d ee".split(), k=r.randint(0, 80))), None, None, None) for i in range(300)]
    more += [(2000 + i, "x " * i + "\t\n" + "y z " * i, None, None, None) for i in range(30)]
    layout = "doc_id long, text string, key string, salt string, runs long"
    df = spark.createDataFrame([*rows, *more], layout).repartition(3)
    salt = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = runs.digests(runs.find_runs(df, "doc_id", "text", salt, queries.repeated_words), "doc_id").collect()
    expected = [plain_row(row[0], row[1]) for row in [*rows, *more]]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert sum(x[1] > 0 for x in expected) > 40


def test_real_outputs(spark):
    df = spark.createDataFrame([("k", "so a b a b a b a b end  end")], "id string, body string")
    row = runs.find_runs(df, "id", "body").first()
    assert (row.id, row.n_words, row.collapsed) == ("k", 11, "so a b end end")
    assert [tuple(x) for x in row.runs] == [(1, 8, 2)]


def test_empty_table_and_very_long_text(spark, nothing):
    assert runs.find_runs(nothing, "doc_id", "text").count() == 0
    long = " ".join(["lead"] + [f"w{i % 5000}" for i in range(60000)])
    df = spark.createDataFrame([(1, long), (2, "z " * 100_000)], "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.find_runs(df, "doc_id", "text").select("doc_id", "runs").collect()}
    assert found == {1: [(1, 60000, 5000)], 2: [(0, 100_000, 1)]}
