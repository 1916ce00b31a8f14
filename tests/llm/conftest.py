import random

import pytest

from larder.llm.queries import rank_file

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ka lo mi ne pu ra so ti vo xu".split()


def sentence(random_, words):
    return " ".join("".join(random_.choices(SYLLABLES, k=random_.randint(1, 3))) for _ in range(words))


def edge_rows():
    """Nulls in every column, empty and white texts, copies, near copies, one long text, repeated rows."""
    r = random.Random(5)
    base = sentence(r, 120)
    texts = [sentence(r, r.randint(1, 60)) for _ in range(40)]
    texts += [None, "", " \t\n", "One", "one", base, base, base.upper(), base + " end", "a\u00a0b c\x1cd", "\u00c4\u00d6 \u5b57 it's x 12"]
    texts += [sentence(r, 4000), "x" * 5000]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "null key", None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return edge_rows(), spark.createDataFrame(edge_rows(), LAYOUT).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], LAYOUT)


@pytest.fixture(scope="session")
def ranks():
    return rank_file()
