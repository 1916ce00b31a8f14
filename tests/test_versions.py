"""Product versions as they are read from the order tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.catalogue import fixtures as fx
from larder.catalogue.queries import QUERIES
from larder.plans import jobs
from larder.sources.workspace import Workspace


@pytest.fixture
def folder(spark, tmp_path):
    day = dt.datetime(1998, 1, 1)
    lines = [(i % 40, i % 7, i % 3, i % 5, float(i), 0.1, 0.02, day + dt.timedelta(days=i % 50)) for i in range(200)]
    lines += lines[:5] + [(None, 1, 1, None, 1.0, 0.1, 0.02, None)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp"),
        "part": ([(i, f"name {i}", f"Brand#{i}", "SMALL", i * 3) for i in range(7)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(i, i) for i in range(3)], "s_suppkey long, s_nationkey int"),
        "nation": ([(i, f"NATION_{i}") for i in range(3)], "n_nationkey int, n_name string"),
    }
    for name, (rows, layout) in tables.items():
        spark.createDataFrame(rows, layout).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_versions_are_spread_before_they_are_expanded(spark, folder, monkeypatch):
    """A task must not sort a whole split of line items as wide rows: their number decides, not their size in the file."""
    whole = fx.versions(spark, folder)
    monkeypatch.setattr(fx, "VERSIONS_PER_TASK", 20)
    spread = fx.versions(spark, folder)
    assert sorted(map(str, spread.collect())) == sorted(map(str, whole.collect())) and spread.count() == 206
    assert spread.rdd.getNumPartitions() == 11
    assert max(spread.rdd.glom().map(len).collect()) < 60


def test_one_exchange_brings_lines_to_tasks_and_parts(spark, folder, monkeypatch):
    """Unless a part fills a task, lines are spread by part as they are, and the join needs no other exchange of them."""
    whole = fx.versions(spark, folder)
    monkeypatch.setattr(fx, "VERSIONS_PER_TASK", 40)
    old = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        parted = fx.versions(spark, folder)
        plan = parted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(l_partkey") == 1
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    parted = fx.versions(spark, folder)
    assert sorted(map(str, parted.collect())) == sorted(map(str, whole.collect()))
    tasks = parted.rdd.map(lambda row: row["code"]).glom().collect()
    assert len(tasks) == 6 and sum(len(set(codes)) for codes in tasks) == 7


def test_fact_and_dates_from_snapshots_stored_once(spark, folder, tmp_path):
    names = ("fact_nutrition_snapshot", "dim_time", "dim_product")
    plain = fx.star(spark, folder, *names)
    with Workspace(spark, f"{tmp_path}/work") as work:
        stored = fx.star(spark, folder, *names, work=work)
        for name in names:
            assert sorted(map(str, stored[name].collect())) == sorted(map(str, plain[name].collect()))
        for name in names[:2]:
            assert not any("lineitem" in file for file in stored[name].inputFiles())


@pytest.fixture
def by_code(spark, tmp_path, monkeypatch):
    """Many parts, two of them with one code, and a session in which rows may be spread by some of the keys that they are grouped by."""
    day = dt.datetime(1998, 1, 1)
    parts = [*range(2000), 12345678901234, 12345678901235]
    lines = [(i, p, i % 3, i % 7, float(i % 90), 0.1, 0.02, day + dt.timedelta(days=i % 50)) for i, p in enumerate(parts * 3)]
    lines += lines[:50] + [(1, None, 1, 1, 1.0, 0.1, 0.02, day), (2, 5, 1, 1, 1.0, 0.1, 0.02, None)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp"),
        "part": ([(p, f"name {p * 7919 % 10007}", f"Brand#{p % 25}", f"SMALL {p * 31 % 97}", p % 50) for p in parts], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(i, i) for i in range(3)], "s_suppkey long, s_nationkey int"),
        "nation": ([(i, f"NATION_{i}") for i in range(3)], "n_nationkey int, n_name string"),
    }
    for name, (rows, layout) in tables.items():
        spark.createDataFrame(rows, layout).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(fx, "VERSIONS_PER_TASK", 500)
    settings = {
        "spark.sql.requireAllClusterKeysForDistribution": "false",
        "spark.sql.autoBroadcastJoinThreshold": "8k",
        "spark.sql.adaptive.enabled": "false",
    }
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield str(tmp_path)
    for name, value in old.items():
        spark.conf.set(name, value)


def exchanges(df):
    """Exchanges of rows by keys; those that are read again count once."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in lines if " Exchange hashpartitioning" in line and "ReusedExchange" not in line]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_wide_rows_of_a_code_need_no_exchange(spark, by_code, monkeypatch):
    """Lines and parts are spread by code, narrow; newest rows per code, or code and date, are found where they are."""
    made = {"versions": fx.versions, "products": fx.products, "snapshots": fx.snapshots}
    spread = {name: make(spark, by_code) for name, make in made.items()}
    for name, df in spread.items():
        assert len(exchanges(df)) == 2 and all("_partkey" in line for line in exchanges(df)), name
    found = {name: rows_of(df) for name, df in spread.items()}
    monkeypatch.setattr(fx, "VERSIONS_PER_TASK", 10**6)
    for name, make in made.items():
        assert found[name] == rows_of(make(spark, by_code)), name
    assert len(found["versions"]) == 2002 * 3 + 51


def test_parts_that_share_a_code_keep_their_lines(spark, by_code):
    long_codes = fx.versions(spark, by_code).where("code = '1234567890123'")
    assert long_codes.count() == 6 and long_codes.select("product_name_en").distinct().count() == 2


def test_lines_are_counted_by_bucket_unless_one_is_too_full(spark):
    lines = spark.createDataFrame([(i % 5,) for i in range(100)] + [(None,)] * 500, "l_partkey long")
    assert fx._line_counts(lines, 20) == (100, False)
    assert fx._line_counts(lines, 19) == (100, True)
    assert fx._line_counts(lines, 100) == (100, False)


@pytest.mark.parametrize("name, most", [("append_no_dupe_rows", 3), ("fact_versions", 3), ("fact_snapshot_lookup", 2)])
def test_line_items_are_sent_once_for_several_tables(spark, by_code, name, most):
    sent = [line for line in exchanges(QUERIES[name](spark, by_code)) if "(l_partkey" in line]
    assert 0 < len(sent) <= most, sent


def test_stored_snapshots_of_a_code_lie_in_one_file(spark, by_code, tmp_path):
    """So the newest row of a code is found by the task that reads it, and one row per code is sent on."""
    jobs.write_silver(fx.snapshots(spark, by_code), f"{tmp_path}/silver")
    stored = spark.read.parquet(f"{tmp_path}/silver/products").select("code", "event_date", F.input_file_name().alias("file"))
    found = stored.groupBy("code").agg(F.countDistinct("file").alias("files"), F.countDistinct("event_date").alias("dates"))
    most = found.agg(F.max("files"), F.max("dates")).first()
    assert most[0] == 1 and most[1] > 1
