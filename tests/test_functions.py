"""Edge rows for the column expressions."""

import datetime as dt
import random
import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from larder.functions import keys as K
from larder.functions import nutrients as N
from larder.functions import quality as Q
from larder.functions import tags as G
from larder.functions import text as X


def apply(spark, values, expression, kind="string"):
    """Result of the expression for each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression(F.col("v")).alias("r"))
    return [r["r"] for r in df.orderBy("i").collect()]


def test_normalise(spark):
    values = ["  A \t B\n", "", None, "É  É"]
    assert apply(spark, values, X.normalise) == ["a b", "", None, "é é"]


def test_canonical_examples(spark):
    values = ["Crème Brûlée", "L'HIVER", "ß-œuf", "!!", None, " İstanbul ", "united-kingdom"]
    expected = ["creme brulee", "l hiver", "ß œuf", "", None, "istanbul", "united kingdom"]
    assert apply(spark, values, X.canonical) == expected


def described(text):
    """The rule in words: lower case, decompose, drop marks, keep letters and digits."""
    text = unicodedata.normalize("NFD", text.strip().lower())
    text = "".join(c for c in text if not unicodedata.combining(c))
    return " ".join("".join(c if c.isalnum() else " " for c in text).split())


def test_canonical_every_letter(spark):
    """Each character of an old Unicode version inside a word.

    Newer characters are letters to one of Python and the JVM and unknown to the other. Letters that
    decompose into several (Hangul syllables, a few Indic vowels) stay composed on purpose.
    """
    old = unicodedata.ucd_3_2_0

    def parts(p):
        return [c for c in unicodedata.normalize("NFD", chr(p)) if not unicodedata.combining(c)]

    points = [
        p
        for p in range(1, sys.maxunicode + 1)
        if old.category(chr(p)) not in ("Cn", "Cs", "Co") and len(parts(p)) < 2
    ]
    values = [f"a{chr(p)}b" for p in points]
    results = apply(spark, values, X.canonical)
    wrong = [(hex(p), r, described(v)) for p, v, r in zip(points, values, results) if r != described(v)]
    assert wrong == []


def test_noise_to_null(spark):
    noise = ["0", "none", "Unknown", "sans marque", "sans_marque", "N/A", "na", "-", "_", "?", "12", "x", "", "  ", "٣٤", "²²"]
    assert apply(spark, noise, X.noise_to_null) == [None] * len(noise)
    kept = [" Nestlé ", " Bio ", "7 up", "none of it", "a1"]
    assert apply(spark, kept, X.noise_to_null) == ["nestlé", "bio", "7 up", "none of it", "a1"]
    assert apply(spark, [None], X.noise_to_null) == [None]


@pytest.mark.parametrize(
    "names, expected",
    [
        (("fr", "gen", "en"), "fr"),
        (("", "gen", "en"), "gen"),
        ((None, "", "en"), "en"),
        (("", None, ""), ""),
        ((None, None, None), None),
    ],
)
def test_preferred_name(spark, names, expected):
    df = spark.createDataFrame([names], "a string, b string, c string")
    assert df.select(X.preferred_name(F.col("a"), F.col("b"), F.col("c"))).first()[0] == expected


def tags(c):
    return G.clean_tags(X.normalise(c))


def codes(c):
    return G.tag_codes(tags(c))


def cleaned(text):
    """The same rules, item by item."""
    noise = {"0", "none", "unknown", "sans marque", "sans_marque", "n/a", "na", "-", "_", "?"}
    keep = lambda x: len(x) > 1 and not (x.isascii() and x.isdigit()) and x not in noise
    items = [" ".join(x.split()).lower() for x in text.replace(";", ",").split(",")]
    items = [x for x in items if keep(x)]
    return items, [c for c in (x.split(":")[1] if ":" in x else x for x in items) if keep(c)]


def test_lists_equal_item_by_item_rules(spark):
    rng = random.Random(3)
    parts = ["en", ":", ",", ";", " ", "a", "12", "n/a", "na", "none", "?", "été", "sans marque", "x y", ",", ":", "𝒳"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert apply(spark, texts, tags) == [cleaned(t)[0] for t in texts]
    assert apply(spark, texts, codes) == [cleaned(t)[1] for t in texts]


def test_clean_tags(spark):
    noise = "0,none,unknown,sans marque,sans_marque,n/a,na,-,_,?,123,x,,"
    values = [noise, "A  B ; c,DD ,, Ee", None, "", " ; ", "?? , 1a"]
    assert apply(spark, values, tags) == [[], ["a b", "dd", "ee"], None, [], [], ["??", "1a"]]


def test_tag_items_keep_empty_items(spark):
    assert apply(spark, ["a, ;b"], lambda c: G.tag_items(X.normalise(c))) == [["a", "", "b"]]


def test_items_equal_item_by_item_cleaning(spark):
    """Cleaning the whole text first gives the same items as cleaning each item."""
    values = [" A ,b  c;; d\t,\tE", ", ,", "a , , b", "x;y ;z; ", "  ", "ΑΣ,ΟΔΟΣ ; σ"]
    one_by_one = lambda c: F.transform(F.split(F.translate(c, ";", ","), ","), X.normalise)
    assert apply(spark, values, lambda c: G.tag_items(X.normalise(c))) == apply(spark, values, one_by_one)


def test_tag_codes(spark):
    values = ["en:bev:x,en:,en:b,plain,fr:77,en:none"]
    assert apply(spark, values, codes) == [["bev", "plain"]]


def test_first_item_of_nothing(spark):
    assert apply(spark, ["0", None, "ab,cd"], lambda c: G.first_item(tags(c))) == [None, None, "ab"]


def test_clamp(spark):
    values = ["1,5", "-1", "abc", "NaN", "100", "100.01", None, "", "Infinity", " 7 "]
    expected = [1.5, None, None, None, 100.0, None, None, None, None, 7.0]
    assert apply(spark, values, lambda c: N.clamp(N.parse_number(c), 0.0, 100.0)) == expected


def test_salt_modes(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (5.0, 9.0)], "salt double, sodium double")
    both = {"salt_100g": F.col("salt"), "sodium_100g": F.col("sodium")}

    def run(numbers, mode):
        filled = N.harmonise_salt(numbers, mode)
        return [tuple(r) for r in df.select(filled["salt_100g"], filled["sodium_100g"]).collect()]

    assert run(both, "column") == [(1.0, None), (None, 2.0), (5.0, 9.0)]
    assert run(both, "row") == [(1.0, 0.4), (5.0, 2.0), (5.0, 9.0)]
    assert run({"salt_100g": F.col("salt")}, "column") == [(1.0, 0.4), (None, None), (5.0, 2.0)]
    assert run({"sodium_100g": F.col("sodium")}, "row") == [(None, None), (5.0, 2.0), (22.5, 9.0)]
    with pytest.raises(ValueError):
        N.harmonise_salt(both, "both")


def test_issues(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, "b", "c"), (30.0, 80.5, None, ""), (None, None, "b", None)],
        "salt double, sugars double, brand string, cat string",
    )
    issues = Q.quality_issues(F.col("salt"), F.col("sugars"), F.col("brand"), F.col("cat"))
    assert [r[0] for r in df.select(F.to_json(issues)).collect()] == [
        "[]",
        '["salt_gt_25","sugars_gt_80","brand_missing","cat_missing"]',
        '["cat_missing"]',
    ]


def test_epoch_and_event_date(spark):
    values = ["0", "1700000000", "1700000000.9", "x", None, str(2**63 - 1)]
    dates = apply(spark, values[:5], lambda c: K.event_date(K.epoch_timestamp(c)))
    day = dt.date(2023, 11, 14)
    assert dates == [dt.date(1970, 1, 1), day, day, dt.date(2000, 1, 1), dt.date(2000, 1, 1)]
    far = apply(spark, values, lambda c: K.date_key(K.event_date(K.epoch_timestamp(c))))
    assert far == [19700101, 20231114, 20231114, 20000101, 20000101, None]


def test_surrogate_key(spark):
    keys = apply(spark, [str(i) for i in range(2000)] + [None], K.surrogate_key)
    assert keys[-1] is None
    assert all(0 <= k < 2**63 for k in keys[:-1])
    assert len(set(keys)) == 2001


def test_json_list(spark):
    values = ['["fr","es"]', "bad", None, '{"a":1}', "[]"]
    assert apply(spark, values, lambda c: G.json_list_items(c)) == [["fr", "es"], None, None, None, []]


def test_edit_distance_limit(spark):
    df = spark.createDataFrame([("é", "e"), ("abc", "xyz")], "a string, b string")
    assert [r[0] for r in df.select(X.edit_distance(F.col("a"), F.col("b"), 2)).collect()] == [1, None]


def test_white_space_of_any_kind_is_collapsed(spark):
    texts = [None, "", " ", "a", " a b ", "a  b", "a\tb", "a\n b", "a\x0bb", "a\fb", "a\r\nb", "a  b", "\t", " é  É "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", X.collapse_spaces(F.col("t")).alias("c")).collect()
    assert [r["c"] for r in found] == [None if t is None else re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ") for t in texts]


def test_issues_as_json(spark):
    rows = spark.createDataFrame(
        [(s, g, b, c) for s in (None, 25.0, 26.0) for g in (None, 80.0, 81.0) for b in (None, "", "x") for c in (None, "", "x")],
        "salt double, sugars double, brand string, category string",
    )
    columns = [F.col(c) for c in rows.columns]
    found = rows.select(Q.quality_issues_json(*columns).alias("text"), F.to_json(Q.quality_issues(*columns)).alias("json")).collect()
    assert len(found) == 81 and all(r["text"] == r["json"] for r in found)
