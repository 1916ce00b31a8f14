"""Golden records over any number of sources, and components of links."""

import os
import random

import pytest
from pyspark.sql import functions as F

from larder.operators import clusters
from larder.sources.workspace import Workspace

LAYOUT = "id string, year int, title string, brand string, price double"


@pytest.fixture
def work(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as folder:
        yield folder


def plain_roots(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {(x, top(x)) for x in root}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "ring"])
def test_components(spark, work, shape):
    r = random.Random(3)
    links = {
        "random": [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(None, 4), (7, None), (9, 9)],
        "chain": [(i, i + 1) for i in range(300)],
        "star": [(500, i) for i in range(300)],
        "ring": [(i, (i + 7) % 60) for i in range(60)] * 2,
    }[shape]
    df = spark.createDataFrame(links, "a long, b long").repartition(3)
    assert {tuple(x) for x in clusters.connected(df, "a", "b", work).collect()} == plain_roots(links)


def test_components_of_nothing(spark, work):
    df = spark.createDataFrame([], "a string, b string")
    assert clusters.connected(df, "a", "b", work).count() == 0


def test_rounds_are_removed(spark, work):
    df = spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long")
    clusters.connected(df, "a", "b", work)
    assert len(os.listdir(work.folder)) == 1
    work.close()
    assert not os.path.exists(work.folder)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(sources):
    """Union over all pairs of names, then the first filled value by source and record id. Titles are canonical already."""
    places, rows = {}, []
    for place, source in enumerate(sources):
        for one in source:
            rows.append((place, *one))
            if one[1] is not None and one[2]:
                places.setdefault((one[1], one[2]), set()).add(place)
    links = [
        (x, y) for x in places for y in places
        if x < y and x[0] == y[0] and one_edit(x[1], y[1]) and len(places[x] | places[y]) > 1
    ]
    root = dict(plain_roots(links))
    groups = {}
    for row in rows:
        place, key, year, title = row[:4]
        node = (year, title)
        group = root.get(node, node) if year is not None and title else ("own", place, key)
        groups.setdefault(group, []).append(row)
    found = []
    for group in groups.values():
        group.sort(key=lambda x: (x[0], x[1]))
        names = {(x[0], x[3]) for x in group}
        first = lambda i: next((x[i] for x in group if x[i] is not None), None)
        found.append(
            (group[0][2], min(names, key=lambda n: (n[0], n[1] or ""))[1], len(group), len({x[0] for x in group}),
             len({x[3] for x in group if x[3] is not None}), first(4), first(5))
        )
    return sorted(found, key=repr)


def run(spark, work, sources):
    frames = [spark.createDataFrame(s, LAYOUT).repartition(2) for s in sources]
    found = clusters.golden_clusters(frames, "year", "title", "id", ["brand", "price"], 1, work)
    assert found.columns == ["block", "name", "n_records", "n_sources", "n_names", "brand", "price"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_a_chain_over_three_sources_is_one_record(spark, work):
    sources = [
        [("1", 2001, "blue bolt", None, None)],
        [("2", 2001, "blue bolts", None, 3.0), ("3", 2001, "blue bolts", "late", 9.0)],
        [("4", 2001, "blue boltsz", "zeta", 5.0), ("5", 2002, "blue bolt", "other year", 1.0)],
    ]
    assert run(spark, work, sources) == [
        (2001, "blue bolt", 4, 3, 3, "late", 3.0),
        (2002, "blue bolt", 1, 1, 1, "other year", 1.0),
    ]


def test_names_of_one_source_alone_are_not_linked(spark, work):
    sources = [[("1", 1, "size 1", "a", None), ("2", 1, "size 2", "b", None)], [("3", 1, "other", None, None)]]
    assert [x[2] for x in run(spark, work, sources)] == [1, 1, 1]


def test_equal_to_brute_force(spark, work):
    r = random.Random(8)
    names = ["".join(r.choices("abc", k=r.randint(2, 4))) for _ in range(25)]
    sources = [
        [
            (f"{place}-{i}", r.choice([1, 2, None]), r.choice([*names, "", None]), r.choice(["x", "y", None]), r.choice([1.0, None]))
            for i in range(40)
        ]
        for place in range(4)
    ]
    assert run(spark, work, sources) == plain(sources)


def test_hot_name_reaches_the_join_once(spark, work):
    """A third of all records has one name; what the last join reads is one row for each name and source."""
    many = spark.range(20_000).select(
        F.col("id").cast("string"), F.lit(1).alias("year"),
        F.when(F.col("id") % 3 == 0, "hot name").otherwise(F.concat(F.lit("n "), (F.col("id") % 500).cast("string"))).alias("title"),
        F.lit("b").alias("brand"), F.lit(1.0).alias("price"),
    )
    few = spark.createDataFrame([("1", 1, "hot names", "first", None)], LAYOUT)
    rows = {x.name: x for x in clusters.golden_clusters([few, many], "year", "title", "id", ["brand", "price"], 1, work).collect()}
    hot = rows["hot names"]
    assert (hot.n_records, hot.n_sources, hot.brand, hot.price) == (6668, 2, "first", 1.0)
