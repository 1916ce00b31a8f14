"""The similarity join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from larder.operators import similarity

LAYOUT = "block int, name string"


def plain_grams(name, q):
    marked = "#" * (q - 1) + name + "$" * (q - 1)
    return {marked[i : i + q] for i in range(len(marked) - q + 1)} or {marked}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def names(seed, letters, n=70, longest=14):
    r = random.Random(seed)
    found = ["".join(r.choices(letters, k=r.randint(1, longest))).strip() or "a" for _ in range(n)]
    for _ in range(n):
        word = list(r.choice(found))
        for _ in range(r.randint(1, 3)):
            spot = r.randrange(len(word) + 1)
            word[spot : spot + r.randint(0, 1)] = r.choices(letters, k=r.randint(0, 1))
        found.append("".join(word).strip() or "b")
    return sorted({(r.randint(1, 2), " ".join(w.split()) or "a") for w in found})


def frames(spark, seed, letters):
    rows = names(seed, letters), names(seed, letters + "z", n=60)
    return rows, [spark.createDataFrame(x, LAYOUT).repartition(3) for x in rows]


@pytest.mark.parametrize("threshold, q, letters, most", [(0.5, 2, "abcd ", 10_000), (0.8, 2, "ab", 2), (0.6, 3, "abcdefgh", 2)])
def test_grams_equal_all_pairs(spark, threshold, q, letters, most):
    (left, right), (a, b) = frames(spark, 1, letters)
    expected = set()
    for block, x in left:
        for other, y in right:
            g, h = plain_grams(x, q), plain_grams(y, q)
            if block == other and len(g & h) / len(g | h) >= threshold:
                expected.add((block, x, y, round(len(g & h) / len(g | h), 9)))
    found = similarity.alike_by_grams(a, b, threshold, q, most).collect()
    assert len(found) == len(expected) > 5
    assert {(r.block, r.left_name, r.right_name, round(r.similarity, 9)) for r in found} == expected


@pytest.mark.parametrize("edits, q, letters, most", [(3, 2, "abcd ", 10_000), (4, 3, "ab", 2), (2, 1, "a", 2)])
def test_edits_equal_all_pairs(spark, edits, q, letters, most):
    """Short names and names of few letters included, which need not share a gram."""
    (left, right), (a, b) = frames(spark, 2, letters)
    expected = {
        (block, x, y, plain_distance(x, y))
        for block, x in left for other, y in right
        if block == other and plain_distance(x, y) <= edits
    }
    found = [tuple(r) for r in similarity.alike_by_edits(a, b, edits, q, most).collect()]
    assert len(found) == len(expected) > 5
    assert set(found) == expected


def test_names_without_block_or_letters(spark):
    df = spark.createDataFrame([(1, "Créme  Brûlée"), (1, "creme brulee"), (None, "creme brulee"), (1, None), (1, "!?")], LAYOUT)
    for options in ({"threshold": 0.9}, {"edits": 1}):
        found = similarity.similar_titles(df, df, "block", "name", **options).collect()
        assert [(r.left_name, r.right_name) for r in found] == [("creme brulee", "creme brulee")]


def test_options(spark):
    df = spark.createDataFrame([], LAYOUT)
    assert similarity.similar_titles(df, df, "block", "name", threshold=0.5).count() == 0
    assert similarity.similar_titles(df, df, "block", "name", edits=2).count() == 0
    for options in ({}, {"threshold": 0.5, "edits": 1}, {"threshold": 0.0}):
        with pytest.raises(ValueError):
            similarity.similar_titles(df, df, "block", "name", **options)


def test_prefixes_are_much_smaller_than_names(spark):
    """Only the seldom grams of a name are joined."""
    r = random.Random(5)
    rows = [(1, " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(4))) for _ in range(200)]
    df = spark.createDataFrame(rows, LAYOUT)
    grams = similarity._gram_rows(df, 2)
    uses = similarity._gram_uses(grams, grams)
    kept = F.col("size") - F.ceil(0.8 * F.col("size")) + 1
    prefixes = similarity._prefixes(grams, uses, kept)
    assert prefixes.count() < 0.3 * grams.count()


def test_plan_joins_on_grams_only(spark):
    df = spark.createDataFrame([(1, f"name {i}") for i in range(50)], LAYOUT)
    for options in ({"threshold": 0.7}, {"edits": 3}):
        plan = similarity.similar_titles(df, df, "block", "name", **options)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("threshold, letters, most", [(0.85, "ab", 10_000), (0.9, "abc", 2), (1.0, "abcd ", 2)])
def test_high_thresholds_equal_all_pairs(spark, threshold, letters, most):
    """Names of few grams, of many and of very many, which meet on one gram or on three."""
    r = random.Random(4)
    long = ["".join(r.choices("abcdefghij", k=n)) for n in (20, 27, 30, 31, 32, 33, 34, 36, 60)]
    long += [x[:-1] for x in long] + [x + "j" for x in long]
    repeated = ["a" * n for n in range(1, 8)] + ["ab" * n for n in range(1, 8)]
    rows = sorted({(n % 2, x) for n in (0, 1) for x in [*long, *repeated, *(y for _, y in names(3, letters))]})
    df = spark.createDataFrame(rows, LAYOUT).repartition(3)
    expected = set()
    for block, x in rows:
        for other, y in rows:
            g, h = plain_grams(x, 2), plain_grams(y, 2)
            if block == other and len(g & h) / len(g | h) >= threshold:
                expected.add((block, x, y))
    found = [(r.block, r.left_name, r.right_name) for r in similarity.alike_by_grams(df, df, threshold, 2, most).collect()]
    assert len(found) == len(expected) > len(rows) * (threshold == 1.0)
    assert set(found) == expected


def test_names_alike_but_for_a_number_hardly_meet(spark, monkeypatch):
    """Pairs that are looked at grow with the names, not with their square."""
    met, looked_at = similarity._met, []
    monkeypatch.setattr(similarity, "_met", lambda *args: looked_at.append(met(*args)) or looked_at[-1])
    for n in (1000, 4000):
        df = spark.createDataFrame([(1, f"customer {i * 37:09d}") for i in range(n)], LAYOUT)
        assert similarity.alike_by_grams(df, df, 0.9, 3).count() >= n
        assert sum(x.count() for x in looked_at) < 20 * n
        looked_at.clear()
