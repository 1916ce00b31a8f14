"""JSON documents of unlike shapes."""

import pytest
from pyspark.sql import types as T

from larder.sources import variants as V

PARTY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("last name", T.StringType()),
    ]
)
PATHS = {"id": ["$.id", "$.ids[1]", "$.key.id"], "name": ["$.name", "$.party.title"], "price": ["$.price", "$.offer['net price']"]}
LINES = [
    '{"id": 1, "name": "a", "price": 1.25, "tags": ["x", null], "last name": "z"}',
    '{"key": {"id": "2"}, "party": {"title": "b"}, "offer": {"net price": "3.5"}}',
    '{"id": "none", "ids": [7, 3], "name": null, "party": {"title": "c"}, "price": "cheap", "offer": {"net price": 4}}',
    '{"id": 9007199254740993, "name": 5, "tags": "x"}',
    "{}",
    "[1, 2]",
    "null",
    "  ",
    '{"id": 1',
    "no document",
    '{"id": 1, "id": 2}',
]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("documents") / "a.json"
    path.write_text("\n".join(LINES), encoding="utf-8")
    return V.read_documents(spark, str(path))


def test_first_path_with_a_value_of_the_type_wins(documents):
    rows = V.as_contract(documents, PARTY, PATHS)
    assert rows.schema.fields[:5] == PARTY.fields
    found = sorted((tuple(r)[:5] for r in rows.collect()), key=repr)
    text = [(r[0], r[1], str(r[2]), r[3], r[4]) for r in found]
    none = (None, None, "None", None, None)
    assert text == [
        (1, "a", "1.25", ["x", None], "z"),
        (2, "b", "3.50", None, None),
        (3, "c", "4.00", None, None),
        (9007199254740993, "5", "None", None, None),
        none,
        none,
        none,
    ]


def test_unreadable_lines_are_kept_apart(documents):
    rows = documents.where("unreadable is not null").collect()
    assert sorted(r.unreadable for r in rows) == ["no document", '{"id": 1', '{"id": 1, "id": 2}']
    assert documents.count() == 10 and all(r.file.endswith("a.json") for r in rows)


def test_names_and_types(documents):
    found = {(r.name, r.type): r.n for r in V.document_paths(documents).collect()}
    assert found[("id", "BIGINT")] == 2 and found[("id", "STRING")] == 1 and found[("name", "VOID")] == 1
    assert found[("ids", "ARRAY<BIGINT>")] == 1 and found[("last name", "STRING")] == 1


def test_path_for_no_column(documents):
    with pytest.raises(ValueError, match="colour"):
        V.as_contract(documents, PARTY, {"colour": ["$.colour"]})
