"""Linkage against brute force, golden records, validity intervals, unlike sources."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import history, linkage
from larder.sources import readers


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            previous, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, previous + (x != y))
    return line[-1]


def random_names(seed, n):
    rng = random.Random(seed)
    return [(rng.randint(1, 3), "".join(rng.choice("abé ") for _ in range(rng.randint(1, 7)))) for _ in range(n)]


def test_remainders(spark):
    names = ["abc", "aa", "", "aba", "abab", "aabb", "bééb"]
    df = spark.createDataFrame([(x,) for x in names], "s string")

    def left(name, edits):
        shorter = {name[:i] + name[i + 1 :] for i in range(len(name))}
        return {name}.union(*(left(x, edits - 1) for x in shorter)) if edits else {name}

    for edits in (1, 2):
        rows = linkage.remainders(df, "s", edits).collect()
        assert {(r.s, r.rest) for r in rows} == {(x, y) for x in names for y in left(x, edits)}
    assert len(linkage.remainders(df.where("s = 'aa'"), "s", 2).collect()) == 3


def test_long_names_two_edits_apart(spark):
    rng = random.Random(5)
    name = "".join(rng.choice("abcdefgh ") for _ in range(600))
    other = name[:100] + name[101:500] + "z" + name[501:]
    frames = [spark.createDataFrame([(1, x)], "block int, name string") for x in (name, other)]
    found = linkage.similar_names(*frames, 2).collect()
    assert [tuple(r) for r in found] == [(1, name, other, 2)]


def test_similar_names_equal_brute_force(spark):
    for edits in (1, 2):
        left, right = set(random_names(edits, 80)), set(random_names(edits + 10, 80))
        frames = [spark.createDataFrame(sorted(x), "block int, name string") for x in (left, right)]
        found = {tuple(r) for r in linkage.similar_names(*frames, edits).collect()}
        expected = {
            (b, x, y, distance(x, y)) for b, x in left for c, y in right if b == c and distance(x, y) <= edits
        }
        assert found == expected


def test_fuzzy_pairs_ignore_copies(spark):
    rows = [(1, "Bière")] * 50 + [(1, "biere")] * 50 + [(1, "bierre"), (2, "bierre"), (1, None), (None, "bier")]
    df = spark.createDataFrame(rows, "b int, t string")
    assert [tuple(r) for r in linkage.fuzzy_pairs(df, "b", "t", 1).collect()] == [(1, "biere", "bierre", 1)]


def test_spellings_are_made_distinct_before_they_are_canonical(spark):
    """The filter on canonical names must not compute them for every row."""
    df = spark.createDataFrame([(1, "Créme"), (1, "creme"), (1, "creme"), (None, "x"), (2, None), (2, "!")], "block int, name string")
    names = linkage.distinct_names(df, "block", "name")
    assert [tuple(r) for r in names.collect()] == [(1, "creme")]
    plan = names._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" in plan and "translate" not in plan[plan.rindex("Aggregate") :]


def test_link_to_master(spark):
    master = spark.createDataFrame([(1, "cold bolt"), (1, "old bolt"), (1, "gold bolt")], "b int, t string")
    incoming = spark.createDataFrame([(1, "OLD BOLT"), (1, "olt bolt"), (1, "mold bolt"), (2, "old bolt")], "b int, t string")
    found = {tuple(r) for r in linkage.link_to_master(master, incoming, "b", "t", 1).collect()}
    assert found == {
        (1, "old bolt", "old bolt", 0),
        (1, "olt bolt", "old bolt", 1),
        (1, "mold bolt", "cold bolt", 1),
        (2, "old bolt", None, None),
    }


def test_golden_records(spark):
    kinds = "b int, t string, id string, brand string, price double"
    master = spark.createDataFrame([(1, "Pain", "m2", None, 2.0), (1, "pain", "m1", None, 1.0), (1, None, "m3", "x", None)], kinds)
    incoming = spark.createDataFrame(
        [(1, "paim", "i2", "late", 9.0), (1, "pain", "i1", "early", 9.0), (1, "eau", "i3", None, 3.0), (1, "", "i4", "y", 1.0)],
        kinds,
    )
    found = linkage.golden_records(master, incoming, "b", "t", "id", ["brand", "price"], 1)
    rows = sorted((tuple(r) for r in found.collect()), key=repr)
    assert rows == [
        (1, "", 1, 1, "y", 1.0),
        (1, "eau", 1, 1, None, 3.0),
        (1, "pain", 4, 2, "early", 1.0),
        (1, None, 1, 1, "x", None),
    ]


# --- history ------------------------------------------------------------------------------------


def day(n):
    return dt.date(2024, 1, n)


def versions(spark, rows):
    return spark.createDataFrame([(k, day(d), a, n) for k, d, a, n in rows], "k string, d date, a string, n int")


END = dt.date(9999, 12, 31)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("k", F.coalesce("a", F.lit("-")), "effective_from", "effective_to", "is_current").collect())


def test_version_history(spark):
    df = versions(
        spark,
        [("x", 1, "a", 1), ("x", 3, "a", 1), ("x", 5, "b", 1), ("x", 5, "c", 2), ("x", 9, None, 1), ("x", 10, None, 1), ("y", 2, "q", 1)],
    )
    found = history.version_history(df, "k", "d", ["a"], tie_breakers=["n"])
    assert as_rows(found) == [
        ("x", "-", day(9), END, 1),
        ("x", "a", day(1), day(5), 0),
        ("x", "c", day(5), day(9), 0),
        ("y", "q", day(2), END, 1),
    ]
    assert found.where("effective_to <= effective_from").count() == 0


def test_first_version_with_null_attribute(spark):
    df = versions(spark, [("x", 1, None, 1), ("x", 2, "b", 1)])
    assert as_rows(history.version_history(df, "k", "d", ["a"])) == [
        ("x", "-", day(1), day(2), 0),
        ("x", "b", day(2), END, 1),
    ]


def test_extending_equals_building_at_once(spark):
    rng = random.Random(5)
    rows = [(k, d, rng.choice("ab"), 0) for k in "xyz" for d in range(1, 29)]
    whole = history.version_history(versions(spark, rows), "k", "d", ["a"])
    old, new = (versions(spark, [r for r in rows if (r[1] < 13) is early]) for early in (True, False))
    stored = history.version_history(old, "k", "d", ["a"])
    assert as_rows(history.extend_history(stored, new, "k", "d", ["a"])) == as_rows(whole)


def test_extend_history_takes_late_and_corrected_versions(spark):
    stored = history.version_history(versions(spark, [("x", 1, "a", 1), ("x", 9, "b", 1)]), "k", "d", ["a"])
    news = versions(spark, [("x", 5, "c", 1), ("x", 9, "d", 1)])
    assert as_rows(history.extend_history(stored, news, "k", "d", ["a"])) == [
        ("x", "a", day(1), day(5), 0),
        ("x", "c", day(5), day(9), 0),
        ("x", "d", day(9), END, 1),
    ]


def test_extend_history_leaves_other_keys_alone(spark):
    stored = history.version_history(versions(spark, [("x", 1, "a", 1), ("y", 1, "a", 1)]), "k", "d", ["a"])
    news = versions(spark, [("x", 4, "b", 1), ("x", 6, "b", 1), ("z", 2, "n", 1)])
    assert as_rows(history.extend_history(stored, news, "k", "d", ["a"])) == [
        ("x", "a", day(1), day(4), 0),
        ("x", "b", day(4), END, 1),
        ("y", "a", day(1), END, 1),
        ("z", "n", day(2), END, 1),
    ]


# --- unlike sources -----------------------------------------------------------------------------

ITEM = T.StructType(
    [T.StructField("title", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("score", T.DoubleType())]
)


def test_csv_json_and_xml_under_one_contract(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name;year\nL'Hiver;1999\nBad;n/a\n")
    (tmp_path / "b.json").write_text('{"title":"Hiver","info":{"year":2000},"score":7.5}\n')
    (tmp_path / "c.xml").write_text("<all><film><title>Été</title><year>2001</year></film></all>")
    a = readers.read_csv_source(spark, str(tmp_path / "a.csv"), "csv", ITEM, {"title": "name"}, sep=";")
    layout = T.StructType.fromDDL("title string, info struct<year:int>, score double")
    b = readers.read_json_source(spark, str(tmp_path / "b.json"), "json", ITEM, layout, {"year": "info.year"})
    c = readers.read_xml_source(
        spark, str(tmp_path / "c.xml"), "xml", ITEM, T.StructType.fromDDL("title string, year int"), "film"
    )
    rows = [tuple(r) for r in a.unionByName(b).unionByName(c).collect()]
    assert rows == [
        ("L'Hiver", 1999, None, "csv"),
        ("Bad", None, None, "csv"),
        ("Hiver", 2000, 7.5, "json"),
        ("Été", 2001, None, "xml"),
    ]
