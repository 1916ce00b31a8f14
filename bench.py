"""Headline timings as one JSON line.

The input of the pipeline (a tab-separated dump of all product versions) is written first and not
timed. Then: the silver job, the gold job, the seven reports on the stored star, and operators on
the given tables. Each figure is the median of the timed runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from larder.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    spark = build_session(
        "larder-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    from larder.catalogue import fixtures
    from larder.catalogue.queries import QUERIES
    from larder.plans import jobs, reports

    work = tempfile.mkdtemp(prefix="larder-bench-")
    dump = f"{work}/dump"
    rows = fixtures.versions(spark, FOLDER).drop(*fixtures.TIE_BREAKERS, "ship_date")
    rows.repartition(int(CPUS)).write.options(header=True, sep="\t", escape='"').csv(dump)
    count = iter(range(1000))

    def silver_job():
        jobs.run_silver(spark, dump, f"{work}/silver", keys=fixtures.SNAPSHOT_KEYS)

    def gold_job():
        jobs.run_gold(spark, f"{work}/silver/products", jobs.parquet_tables(f"{work}/gold{next(count)}"))

    def finish(df):
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}

    def measure(name, job):
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            job()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)

    measure("silver_job", silver_job)
    measure("gold_job", gold_job)

    star = jobs.stored_star(spark, f"{work}/gold0")
    fact, product, brand = star["fact_nutrition_snapshot"], star["dim_product"], star["dim_brand"]
    category, day = star["dim_category"], star["dim_time"]
    stored = {
        "report_brand_grade_share": lambda: reports.top_brands_by_grade(fact, product, brand),
        "report_grade_by_category": lambda: reports.grade_by_category(fact, product, category),
        "report_sugar_heatmap": lambda: reports.sugar_by_category_and_country(fact, product, category),
        "report_brand_completeness": lambda: reports.completeness_by_brand(fact, product, brand),
        "report_anomalies": lambda: reports.anomalies(fact, product, category),
        "report_weekly_completeness": lambda: reports.weekly_completeness(fact, day),
        "report_least_complete_categories": lambda: reports.least_complete_categories(fact, product, category),
    }
    for name, make in stored.items():
        measure(name, lambda make=make: finish(make()))

    for name in (
        "canon_text",
        "keep_latest_products",
        "audit_unique",
        "fuzzy_linkage",
        "link_offers",
        "golden_record",
        "scd2_history",
    ):
        measure(name, lambda name=name: finish(QUERIES[name](spark, FOLDER)))

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds over the headline jobs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(FOLDER.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
