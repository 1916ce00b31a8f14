"""Spelling variants against a plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from larder.llm import spelling

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(word):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in word)


def plain_counts(rows, every):
    counts = Counter()
    for key, text in rows:
        for word in LETTERS.findall(text or ""):
            word = lowered(word)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if every and h % every == 0:
                spot = h % len(word)
                word = word[:spot] + word[spot + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, every=None):
    counts, forms = plain_counts(rows, every), {}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    found = []
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        found.append((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return sorted(found, key=repr)


def variants(seed, words=60):
    """Words with errors on top of errors, permutations of each other, and accents."""
    r = random.Random(seed)
    known = ["".join(r.choices("abcdeéÿ", k=r.randint(6, 9))) for _ in range(words)]
    for _ in range(4 * words):
        w = list(r.choice(known))
        spot = r.randrange(len(w))
        change = r.randrange(4)
        if change == 0:
            w[spot] = r.choice("abczé")
        elif change == 1:
            w.insert(spot, r.choice("abczé"))
        elif change == 2:
            del w[spot]
        else:
            r.shuffle(w)
        known.append("".join(w))
    rows = []
    for i, w in enumerate(known):
        rows += [(i % 17, w.upper() if j % 3 else w) for j in range(r.choice([4, 5, 5, 25, 30, 125, 160]))]
    rows += [(i, w) for w, n in (("chainaa", 10), ("chainab", 90), ("chainbb", 900)) for i in range(n)]
    r.shuffle(rows)
    return [(key, " ".join(w for _, w in rows[i : i + 50])) for i, (key, _) in enumerate(rows) if i % 50 == 0]


def run(df, **options):
    return sorted(map(tuple, spelling.group_variants(df, "doc_id", "text", **options).collect()), key=repr)


@pytest.mark.parametrize("every, most", [(None, 8192), (7, 8192), (None, 3), (7, 1)])
def test_all_rows_equal_the_plain_comparison(spark, every, most):
    """With few words a slice, all cells are dealt to several tasks."""
    rows = variants(every or 1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain(rows, every)
    assert run(df, every=every, most=most) == expected
    assert any(x[1] for x in expected) and any(x[2] not in (x[0], x[1]) for x in expected)


def test_very_long_words(spark):
    base = "q" * 3000
    words = [base, base[:-1], base[:-1] + "x", "x" + base[1:], base + "y", base[:-2] + "xx"]
    rows = [(i, f"{w} 1 {w}, {w}/{w};{w}") for i, w in enumerate(words)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_edge_rows(spark, edges):
    rows, df = edges
    texts = [(r[0], r[1]) for r in rows]
    assert run(df.withColumnsRenamed({"lang": "word", "source": "n", "n_chars": "cell"})) == plain(texts)


def test_nothing(spark, nothing):
    assert run(nothing) == []
    assert run(spark.createDataFrame([(None, None), (1, ""), (2, "short ×")], "doc_id long, text string")) == []


def test_counts_and_classes(spark):
    df = spark.createDataFrame([(1, "Straßen STRAßEN straßen42straßen Éclairée")], "doc_id long, text string")
    assert {tuple(r) for r in spelling.word_counts(df, "doc_id", "text").collect()} == {
        ("straßen", 4),
        ("Éclairée", 1),
    }
    assert [spelling.classes_for(n) for n in (0, 1000, 500_000, 10**7)] == [3, 3, 6, 8]


def test_each_pair_of_neighbour_cells_meets_once(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choices("abcdef", k=r.choice([6, 7]))) for _ in range(300)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    for most in (8192, 2):
        rows = spelling.visits(df, 4, most).collect()
        at = {}
        for row in rows:
            at.setdefault((row.cell, row.slice), []).append((row.role, row.word))
        met = Counter()
        for there in at.values():
            home = [w for role, w in there if role == 0]
            assert len({len(w) for w in home}) <= 1
            for a in home:
                met.update(frozenset((a, b)) for b in home if a < b)
                met.update(frozenset((a, b)) for role, b in there if role)
        assert set(met.values()) == {1}
        assert all(frozenset((a, b)) in met for a in words for b in words if a < b and one_edit(a, b))
