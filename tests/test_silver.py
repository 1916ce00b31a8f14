"""Silver plan on hand-made bronze rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from larder.operators import audit
from larder.operators.columns import conform, ensure_columns, keep_known, plain_names, union_sources
from larder.operators.dedup import keep_latest, upsert_latest
from larder.plans import jobs
from larder.plans.silver import run_metrics, silver_products
from larder.schemas import BRONZE, BRONZE_COLUMNS, SILVER
from larder.sources.readers import read_bronze, read_silver


def bronze(spark, *rows):
    names = list(dict.fromkeys(k for row in rows for k in row))
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def by_code(df):
    return {r["code"]: r for r in df.collect()}


FULL = {
    "code": "0012",
    "product_name": "Pain",
    "brands": "Unknown; Bon  Pain",
    "categories_tags": "en:breads,fr:pain",
    "countries_tags": "en:france",
    "nutriscore_grade": " B ",
    "last_modified_t": "1700000000",
    "energy-kcal_100g": "250,5",
    "sugars_100g": "3",
    "salt_100g": "1",
    "proteins_100g": "8",
    "fat_100g": "2",
}


def test_full_row(spark):
    row = silver_products(bronze(spark, FULL)).first()
    assert row.asDict()["code"] == "0012"
    assert row["brand_primary"] == "bon pain"
    assert row["categories_codes"] == ["breads", "pain"]
    assert row["primary_category_code"] == "breads"
    assert row["country_primary_code"] == "france"
    assert row["nutriscore_grade"] == "b"
    assert row["energy-kcal_100g"] == 250.5
    assert row["sodium_100g"] == 0.4
    assert row["event_date"] == dt.date(2023, 11, 14)
    assert (row["has_name"], row["has_brands"], row["core_nutrients_count"]) == (1, 1, 5)
    assert row["completeness_score"] == 1.0
    assert row["quality_issues_json"] == "[]"


def test_layout_is_fixed(spark):
    for row in (FULL, {"code": "1"}):
        df = silver_products(bronze(spark, row))
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER]


def test_missing_columns_do_not_fail(spark):
    row = silver_products(bronze(spark, {"code": "1", "sugars_100g": "5"})).first()
    # One nutrient column is present, so the score is out of 3.
    assert row["completeness_score"] == pytest.approx(1 / 3)
    assert row["event_date"] == dt.date(2000, 1, 1)
    assert json.loads(row["quality_issues_json"]) == ["brand_missing", "cat_missing"]
    no_code = silver_products(bronze(spark, {"brands": "aa"}, {"brands": "bb"}))
    assert no_code.count() == 2


def test_sodium_column_gives_salt(spark):
    row = silver_products(bronze(spark, {"code": "1", "sodium_100g": "2"})).first()
    assert (row["salt_100g"], row["core_nutrients_count"]) == (5.0, 1)
    assert row["completeness_score"] == pytest.approx(1 / 3)


def test_issue_is_judged_before_clamping(spark):
    row = silver_products(bronze(spark, {**FULL, "salt_100g": "30", "sugars_100g": "85"})).first()
    assert row["salt_100g"] is None and row["sugars_100g"] == 85.0
    assert json.loads(row["quality_issues_json"]) == ["salt_gt_25", "sugars_gt_80"]


def test_newest_row_per_code(spark):
    rows = [
        {"code": "1", "brands": "old", "last_modified_t": "100"},
        {"code": "1", "brands": "new", "last_modified_t": "200"},
        {"code": "1", "brands": "undated", "last_modified_t": None},
        {"code": None, "brands": "xx", "last_modified_t": "1"},
        {"code": None, "brands": "yy", "last_modified_t": "2"},
    ]
    found = by_code(silver_products(bronze(spark, *rows)))
    assert {c: r["brands"] for c, r in found.items()} == {"1": "new", None: "yy"}


def test_ties_do_not_depend_on_order(spark):
    rows = [{"code": "1", "brands": f"b{i}", "last_modified_t": "5"} for i in range(20)]
    kept = {silver_products(bronze(spark, *order)).first()["brands"] for order in (rows, rows[::-1])}
    assert len(kept) == 1


def test_dedup_is_idempotent(spark):
    rows = [{"code": str(i % 7), "brands": f"b{i}", "last_modified_t": str(i)} for i in range(50)]
    once = keep_latest(bronze(spark, *rows), ["code"], F.col("last_modified_t").cast("int"))
    twice = keep_latest(once, ["code"], F.col("last_modified_t").cast("int"))
    assert once.exceptAll(twice).count() == 0 and once.count() == 7


def test_one_row_per_code_and_day(spark):
    rows = [{"code": "1", "last_modified_t": str(86400 * d + h)} for d in range(3) for h in range(4)]
    df = silver_products(bronze(spark, *rows), ("code", "event_date"))
    assert sorted(r["last_modified_t"] for r in df.collect()) == ["172803", "3", "86403"]


def test_hot_key_is_reduced_before_the_exchange(spark):
    """A group limit under the exchange: each map task sends at most one row per key."""
    code = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(1000).select(code.alias("code"), F.col("id").alias("t"))
    plan = keep_latest(df, ["code"], F.col("t"))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_upsert(spark):
    target = bronze(spark, {"code": "1", "t": "5"}, {"code": "2", "t": "5"})
    incoming = bronze(spark, {"code": "2", "t": "6"}, {"code": "3", "t": "1"}, {"code": "1", "t": "4"})
    merged = upsert_latest(target, incoming, ["code"], F.col("t"))
    assert sorted(tuple(r) for r in merged.collect()) == [("1", "5"), ("2", "6"), ("3", "1")]


def test_columns(spark):
    df = bronze(spark, {"b": "x", "a": "7", "extra": "z"})
    assert keep_known(df, ["a", "missing", "b"]).columns == ["a", "b"]
    added = ensure_columns(df, {"n": SILVER["has_name"].dataType, "a": BRONZE["code"].dataType})
    assert added.columns == ["b", "a", "extra", "n"] and added.first()["n"] is None
    assert plain_names(bronze(spark, {"x-y_z": "1"})).columns == ["x_y_z"]
    typed = conform(bronze(spark, {"has_name": "x", "code": "9"}), SILVER).first()
    assert typed["has_name"] is None and typed["code"] == "9"
    both = union_sources(bronze(spark, {"a": "1"}), bronze(spark, {"b": "2"}))
    assert sorted(map(tuple, both.collect()), key=repr) == [("1", None), (None, "2")]


def write_dump(path, rows, gz=False):
    import gzip

    opener = gzip.open if gz else open
    with opener(path, "wt", encoding="utf-8") as f:
        names = list(rows[0])
        f.write("\t".join(["unused", *names]) + "\n")
        for row in rows:
            f.write("\t".join(["-", *[row[n] or "" for n in names]]) + "\n")


@pytest.mark.parametrize("gz", [False, True])
def test_bronze_scan(spark, tmp_path, gz):
    rows = [FULL, {**FULL, "code": "00000000000000000000123", "brands": '"a ""quoted"" name"', "fat_100g": None}]
    path = str(tmp_path / ("dump.tsv.gz" if gz else "dump.tsv"))
    write_dump(path, rows, gz)
    df = read_bronze(spark, path, partitions=3 if gz else None)
    assert set(df.columns) <= set(BRONZE_COLUMNS) and "unused" not in df.columns
    assert {t for _, t in df.dtypes} == {"string"}
    found = by_code(df)
    assert found["0012"]["sugars_100g"] == "3"
    assert found["00000000000000000000123"]["brands"] == 'a "quoted" name'
    assert found["00000000000000000000123"]["fat_100g"] is None


def test_silver_job(spark, tmp_path):
    rows = [{**FULL, "code": f"{i:04d}", "sugars_100g": str(i), "last_modified_t": str(t)} for i in range(150) for t in (1, 2)]
    path, out = str(tmp_path / "dump.tsv"), str(tmp_path / "out")
    write_dump(path, rows)
    metrics = jobs.run_silver(spark, path, out, sample_rows=5)
    assert (metrics["rows_total"], metrics["rows_with_code"], metrics["rows_with_sugars_100g"]) == (150, 150, 101)
    files = jobs.SilverOutput.under(out)
    stored = read_silver(spark, files.table)
    assert stored.where("last_modified_t <> '2'").count() == 0
    written = spark.read.json(files.metrics).first()
    again = run_metrics(stored).first()
    assert written["rows_total"] == 150 and written["columns"] == SILVER.names
    assert written["avg_completeness_score"] == pytest.approx(again["avg_completeness_score"])
    sample = spark.read.option("header", True).csv(files.sample)
    assert [r["code"] for r in sample.collect()] == [f"{i:04d}" for i in range(5)]
    assert json.loads(sample.first()["categories_codes"].replace('\\"', '"')) == ["breads", "pain"]
    checks = audit.silver_checks(run_metrics(stored)).first()
    assert checks["has_rows"] and checks["codes_complete"] and checks["has_score"]
    # A second run replaces the first.
    assert jobs.run_silver(spark, path, out)["rows_total"] == 150
    assert read_silver(spark, files.table).count() == 150


def test_sample_of_a_small_table(spark):
    from larder.sources.sinks import csv_sample

    df = bronze(spark, {"code": "2"}, {"code": None}, {"code": "1"})
    assert [r["code"] for r in csv_sample(df, "code", 10).collect()] == ["1", "2", None]
    assert [r["code"] for r in csv_sample(df, "code", 2).collect()] == ["1", "2"]


def test_sources_chosen_before_the_exchange_give_the_same_rows(spark):
    """Ties that only the hash of the row settles included."""
    rows = spark.range(300).select(
        (F.col("id") % 20).cast("string").alias("code"),
        F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "Nom").alias("product_name_fr"),
        F.when(F.col("id") % 7 > 2, F.concat(F.lit("name "), F.col("id"))).alias("product_name"),
        F.lit("Name").alias("product_name_en"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("en:Tea,77,fr:x "), F.col("id"))).alias("categories_tags"),
        F.concat(F.lit(" Tea ;  b"), F.col("id")).alias("categories"),
        F.when(F.col("id") % 4 > 1, "").alias("countries_tags"),
        F.lit("France,Spain").alias("countries"),
        (F.col("id") % 2 * 86400).cast("string").alias("last_modified_t"),
    )
    for keys in (("code",), ("code", "event_date")):
        found = [silver_products(rows, keys, sources_first=first) for first in (False, True)]
        assert found[0].schema == found[1].schema
        a, b = (sorted(map(str, x.collect())) for x in found)
        assert a == b and len(a) == 20
