"""Files of the fact by year and product."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators.columns import conform
from larder.plans import reports
from larder.schemas import DIM_PRODUCT, DIM_TIME, FACT_NUTRITION_SNAPSHOT
from larder.sources import layout

N = 4000


@pytest.fixture(scope="module")
def tables(spark):
    """A third of all rows are of product 7."""
    day = F.date_add(F.lit(dt.date(2019, 1, 1)), (F.col("id") % 1800).cast("int"))
    fact = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("product_sk"),
        F.when(F.col("id") % 100 > 0, F.date_format(day, "yyyyMMdd").cast("int")).alias("time_sk"),
        ((F.col("id") % 8) / 8).alias("completeness_score"),
        F.element_at(F.array(*map(F.lit, "abcde")), (F.col("id") % 5 + 1).cast("int")).alias("nutriscore_grade"),
    )
    product = spark.range(60).select(F.col("id").alias("product_sk"), F.col("id").cast("string").alias("code"))
    date = F.date_add(F.lit(dt.date(2019, 1, 1)), F.col("id").cast("int"))
    time = spark.range(1800).select(date.alias("date")).select(
        "date", F.date_format("date", "yyyyMMdd").cast("int").alias("time_sk"), F.year("date").alias("year"),
        F.month("date").alias("month"), F.weekofyear("date").alias("iso_week"),
    )
    return conform(fact, FACT_NUTRITION_SNAPSHOT), conform(product, DIM_PRODUCT), conform(time, DIM_TIME)


@pytest.fixture(scope="module")
def opened(spark, tables, tmp_path_factory):
    place = layout.LaidOut(f"{tmp_path_factory.mktemp('gold')}/fact", buckets=4)
    place.write(*tables[:2])
    with pytest.raises(ValueError, match="exists"):
        place.write(*tables[:2])
    return place.open(spark)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return sorted(map(tuple, df.select(*order).collect()), key=repr)


def test_rows_are_all_there(tables, opened):
    names = FACT_NUTRITION_SNAPSHOT.names
    assert rows(opened[layout.FACT], *names) == rows(tables[0].where("time_sk is not null"), *names)
    assert opened[layout.FACT].where("year <> floor(time_sk / 10000)").count() == 0
    assert rows(opened[layout.DIMENSION], *DIM_PRODUCT.names) == rows(tables[1], *DIM_PRODUCT.names)


def test_files_are_few(opened):
    files = opened[layout.FACT].inputFiles()
    assert len(files) <= 4 * 5


def test_product_join_has_no_exchange(opened, no_broadcast):
    joined = opened[layout.FACT].join(opened[layout.DIMENSION].select("product_sk", "code"), "product_sk")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == N - N // 100


def test_counts_per_product_need_no_exchange(opened):
    assert "Exchange" not in plan(opened[layout.FACT].groupBy("product_sk").count())


def test_years_asked_for_by_number_are_the_only_ones_listed(spark, tables, opened, tmp_path):
    tables[2].write.parquet(f"{tmp_path}/time")
    fact = layout.dated(opened[layout.FACT], spark.read.parquet(f"{tmp_path}/time").where("year = 2021"))
    filters = plan(fact).split("PartitionFilters: [")[1].split("]")[0]
    assert "= 2021)" in filters
    assert fact.count() == tables[0].where("time_sk between 20210000 and 20219999").count()


def test_weekly_report_reads_only_the_years_its_days_are_in(spark, tables, opened, tmp_path):
    fact, _, time = tables
    time.write.parquet(f"{tmp_path}/time")
    days = spark.read.parquet(f"{tmp_path}/time").where("date between date'2020-11-01' and date'2021-02-01'")
    read = layout.dated(opened[layout.FACT], days)
    text = plan(read)
    assert "dynamicpruning" in text
    report = reports.weekly_completeness(read, days, min_rows=1)
    plain = reports.weekly_completeness(fact, days, min_rows=1)
    assert rows(report, *report.columns) == rows(plain, *plain.columns)
    assert report.count() > 10
    read.collect()
    scans, found = [read._jdf.queryExecution().executedPlan()], []
    while scans:
        node = scans.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        scans += [children.apply(i) for i in range(children.size())]
    assert found == [2]


def test_no_task_sorts_a_whole_bucket(spark, tables, tmp_path):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        place = layout.LaidOut(f"{tmp_path}/fact", buckets=2)
        place.write(*tables[:2])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    fact = place.open(spark)[layout.FACT]
    files = [file.rpartition("/")[2] for file in fact.inputFiles()]
    assert len(files) <= 2 * 5 and len({file.split("-")[1] for file in files}) > 2
    assert fact.count() == tables[0].where("time_sk is not null").count()
    assert "Exchange" not in plan(fact.groupBy("product_sk").count())
