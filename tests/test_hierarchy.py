"""Category hierarchy from lists, against plain counting and walking."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.operators import audit, hierarchy
from larder.plans import star
from larder.schemas import SILVER
from larder.sources.workspace import Workspace


@pytest.fixture
def work(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as folder:
        yield folder


def plain_parents(lists):
    votes = {}
    for codes in lists:
        for i, code in enumerate(codes or []):
            votes.setdefault(code, Counter())[codes[i - 1] if i else None] += 1
    parents = {
        code: min(found, key=lambda p: (-found[p], p is not None, p or "")) for code, found in votes.items()
    }
    cut = set()
    for code in parents:
        seen, at = [], code
        while at is not None and at not in seen:
            seen.append(at)
            at = parents[at]
        if at is not None:
            cut.add(min(seen[seen.index(at) :]))
    return {code: None if code in cut else parent for code, parent in parents.items()}


def plain_ancestors(parents):
    found = set()
    for code in parents:
        at, distance = code, 0
        while at is not None:
            found.add((code, at, distance))
            at, distance = parents[at], distance + 1
    return found


def random_lists(seed, codes, count):
    r = random.Random(seed)
    names = [f"c{i}" for i in range(codes)]
    return [r.sample(names, r.randint(0, min(6, codes))) for _ in range(count)] + [None, []]


@pytest.mark.parametrize("seed, codes, count", [(1, 8, 30), (2, 40, 60), (3, 3, 200)])
def test_parents_levels_and_ancestors(spark, work, seed, codes, count):
    """Random lists are full of circles."""
    lists = random_lists(seed, codes, count)
    df = spark.createDataFrame([(x,) for x in lists], "codes array<string>").repartition(3)
    parents = hierarchy.category_parents(df, "codes", work)
    expected = plain_parents(lists)
    assert {r.code: r.parent for r in parents.collect()} == expected
    above = hierarchy.category_ancestors(parents)
    assert {tuple(r) for r in above.collect()} == plain_ancestors(expected)
    depth = Counter(code for code, _, _ in plain_ancestors(expected))
    levels = hierarchy.category_levels(parents, above).collect()
    assert {(r.code, r.parent, r.level) for r in levels} == {(c, p, depth[c]) for c, p in expected.items()}


def test_rings_are_cut_once(spark, work):
    """One ring of seven, a ring of two, a loop is impossible as lists hold a code once."""
    lists = [[f"r{i}", f"r{(i + 1) % 7}"] for i in range(7) for _ in range(2)] + [["x", "y"], ["y", "x"]] * 2 + [["r3", "leaf"]]
    # A vote for the top each would win the tie, so every edge is there twice and each code is first twice as well.
    lists += [["start", f"r{i}", f"r{(i + 1) % 7}"] for i in range(7)] + [["start", "x", "y"]]
    df = spark.createDataFrame([(x,) for x in lists], "codes array<string>")
    assert {r.code: r.parent for r in hierarchy.category_parents(df, "codes", work).collect()} == plain_parents(lists)
    assert any(p is not None for p in plain_parents(lists).values())


def test_nothing(spark, work):
    df = spark.createDataFrame([(None,), ([],)], "codes array<string>")
    parents = hierarchy.category_parents(df, "codes", work)
    assert parents.count() == 0
    assert hierarchy.category_ancestors(parents).count() == 0


def test_roll_up(spark):
    parents = {"a": None, "b": "a", "c": "b", "d": "a"}
    above = spark.createDataFrame(sorted(plain_ancestors(parents)), "code string, ancestor string, distance int")
    report = spark.createDataFrame(
        [("c", "x", 1), ("c", "x", 2), ("c", "y", 4), ("d", "x", 8), ("a", "x", 16), ("other", "x", 32), (None, "x", 64)],
        "category string, grade string, n long",
    )
    found = {(r.category, r.grade): r.n for r in hierarchy.rolled_up(report, "category", above, ["n"], ["grade"]).collect()}
    assert found == {
        ("a", "x"): 27, ("a", "y"): 4, ("b", "x"): 3, ("b", "y"): 4, ("c", "x"): 3, ("c", "y"): 4, ("d", "x"): 8,
        ("other", "x"): 32, (None, "x"): 64,
    }


def test_dimension_with_levels(spark, work):
    """Keys of parents are keys of the dimension, so the foreign-key check has something to say."""
    rows = [(str(i), ["Foods", "Sweets", "Bon-Bons"]) for i in range(3)] + [("9", ["foods", "drinks"]), ("8", None)]
    silver = spark.createDataFrame(rows, "code string, categories_codes array<string>")
    category = star.dim_category_levels(silver, work)
    by_code = {r.category_code: r for r in category.collect()}
    assert {c: r.level for c, r in by_code.items()} == {"foods": 1, "sweets": 2, "bon bons": 3, "drinks": 2}
    assert by_code["bon bons"].parent_category_sk == by_code["sweets"].category_sk
    assert by_code["foods"].parent_category_sk is None
    assert audit.orphan_keys(category, "parent_category_sk", category, "category_sk").count() == 0
    broken = category.where(F.col("category_code") != "foods")
    assert audit.orphan_keys(broken, "parent_category_sk", broken, "category_sk").first().n == 2
    assert SILVER["categories_codes"].dataType.simpleString() == "array<string>"
