"""Registered queries: each operator over the whole of its input tables.

Surrogate keys stay inside; results show natural keys, so any engine can check them. Dates are
shown as ISO text and lists as joined text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.catalogue import fixtures as fx
from larder.catalogue.scratch import scratch_folder
from larder.functions import nutrients as N
from larder.functions import tags as G
from larder.functions import text as X
from larder.operators import audit, clusters, hierarchy, history, linkage, similarity
from larder.operators.append import append_no_dupe, unseen_rows
from larder.operators.columns import conform, plain_names, union_sources
from larder.operators.dedup import distinct_keys, keep_latest, upsert_latest
from larder.plans import jobs, reports
from larder.plans import silver as S
from larder.plans import star as star_plan
from larder.schemas import BRONZE, GOLD, LOAD_KEYS
from larder.sources import layout, quarantine, readers, sinks, variants
from larder.sources.tables import ParquetTable
from larder.sources.upsert import KeyedTable
from larder.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROW_KEY = ("code", *fx.TIE_BREAKERS)
# First load against second load.
CUT = "1998-07-01"

_FACT = "fact_nutrition_snapshot"
_BRIDGE = "bridge_product_category"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _text(*columns: str):
    return [F.col(c).cast("string").alias(c) for c in columns]


def _joined(*columns: str):
    return [G.items_as_text(F.col(c)).alias(c) for c in columns]


# --- columns and text ---------------------------------------------------------------------------


@query
def column_conform(spark: SparkSession, folder: str) -> DataFrame:
    return plain_names(conform(fx.versions(spark, folder), BRONZE))


@query
def text_normalise(spark: SparkSession, folder: str) -> DataFrame:
    docs = fx.table(spark, folder, "documents")
    return docs.select("doc_id", X.normalise(F.col("text")).alias("normalised"))


@query
def text_normalise_brands(spark: SparkSession, folder: str) -> DataFrame:
    return fx.versions(spark, folder).select(*ROW_KEY, X.normalise(F.col("brands")).alias("brands"))


@query
def canon_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = fx.table(spark, folder, "documents")
    return docs.select("doc_id", X.canonical(F.col("text")).alias("canonical"))


@query
def noise_to_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.versions(spark, folder).select("brands", X.noise_to_null(F.col("brands")).alias("kept"))
    return rows.groupBy("brands", "kept").agg(F.count(F.lit(1)).alias("n"))


@query
def preferred_name(spark: SparkSession, folder: str) -> DataFrame:
    return S.with_names(fx.versions(spark, folder)).select(*ROW_KEY, "product_name_pref")


# --- tag lists ----------------------------------------------------------------------------------


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    return S.with_tags(S.with_names(fx.versions(spark, folder)))


@query
def clean_tags_brands(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged(spark, folder).select(*ROW_KEY, *_joined("brands_arr", "brands_clean_arr"))


@query
def tag_codes_categories(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged(spark, folder).select(*ROW_KEY, *_joined("categories_arr", "categories_codes"))


@query
def tag_codes_countries(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged(spark, folder).select(*ROW_KEY, *_joined("countries_arr", "countries_codes"))


@query
def primary_elements(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged(spark, folder).select(
        *ROW_KEY, "brand_primary", "primary_category_code", "country_primary_code"
    )


# --- nutrients ----------------------------------------------------------------------------------


@query
def clamp_nutrients(spark: SparkSession, folder: str) -> DataFrame:
    return plain_names(
        S.with_nutrients(fx.versions(spark, folder)).select(*ROW_KEY, *N.NUTRIENT_BOUNDS)
    )


@query
def salt_sodium_column(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.with_nutrients(fx.versions(spark, folder), "column")
    return rows.select(*ROW_KEY, "salt_100g", "sodium_100g")


@query
def salt_sodium_row(spark: SparkSession, folder: str) -> DataFrame:
    sodium = F.expr("case when nova_group = '3' then null else proteins_100g end")
    rows = S.with_nutrients(fx.versions(spark, folder).withColumn("sodium_100g", sodium), "row")
    return rows.select(*ROW_KEY, "salt_100g", "sodium_100g")


# --- duplicates ---------------------------------------------------------------------------------


@query
def keep_latest_products(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.latest_versions(fx.versions(spark, folder), ("code",), fx.TIE_BREAKERS)
    return rows.select(*ROW_KEY, *_text("last_modified_ts", "event_date"), "countries")


@query
def keep_latest_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.latest_versions(fx.versions(spark, folder), fx.SNAPSHOT_KEYS, fx.TIE_BREAKERS)
    return rows.select(*ROW_KEY, *_text("event_date"))


@query
def keep_latest_events(spark: SparkSession, folder: str) -> DataFrame:
    events = fx.table(spark, folder, "events")
    rows = keep_latest(events, ["user_id"], F.col("ts"), ["event_id"])
    micros = F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros")
    return rows.select("user_id", "event_id", micros, "event_type", "value")


@query
def keep_any(spark: SparkSession, folder: str) -> DataFrame:
    """Without a time column any row of a code may stay; what is certain are the codes."""
    rows = fx.versions(spark, folder).drop("last_modified_t")
    return S.latest_versions(rows).select("code")


@query
def distinct_brands(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_keys(fx.versions(spark, folder), F.col("brands"), F.col("countries"))


@query
def upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.with_event_time(fx.versions(spark, folder))
    newest = F.col("last_modified_ts")
    stored = keep_latest(rows.where(F.col("ship_date") < CUT), ["code"], newest, fx.TIE_BREAKERS)
    incoming = rows.where(F.col("ship_date") >= CUT)
    merged = upsert_latest(stored, incoming, ["code"], newest, fx.TIE_BREAKERS)
    return merged.select(*ROW_KEY, *_text("event_date"))


@query
def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """As ``upsert``, into a stored table and with the second load twice."""
    rows = S.with_event_time(fx.versions(spark, folder)).select(*ROW_KEY, "last_modified_ts", "event_date", "ship_date")
    table = KeyedTable(f"{scratch_folder(spark)}/products", rows.schema, ("code",), parts=16)
    late = F.col("ship_date") >= CUT
    for load in (rows.where(~late), rows.where(late), rows.where(late)):
        table.upsert(load, F.col("last_modified_ts"), fx.TIE_BREAKERS)
    return table.read(spark).select(*ROW_KEY, *_text("event_date"))


# --- whole silver table -------------------------------------------------------------------------


@query
def event_date_default(spark: SparkSession, folder: str) -> DataFrame:
    return S.with_event_time(fx.versions(spark, folder)).select(
        *ROW_KEY, *_text("last_modified_ts", "event_date")
    )


@query
def completeness(spark: SparkSession, folder: str) -> DataFrame:
    return fx.snapshots(spark, folder).select(
        "code", *_text("event_date"), "has_name", "has_brands", "core_nutrients_count", "completeness_score"
    )


@query
def quality_issues(spark: SparkSession, folder: str) -> DataFrame:
    return fx.snapshots(spark, folder).select("code", *_text("event_date"), "quality_issues_json")


@query
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = audit.silver_checks(S.run_metrics(fx.products(spark, folder)))
    return metrics.withColumn("avg_completeness_score", F.round("avg_completeness_score", 9))


def _silver_view(silver: DataFrame) -> DataFrame:
    lists = [f.name for f in silver.schema.fields if isinstance(f.dataType, T.ArrayType)]
    texts = ["last_modified_ts", "event_date"]
    others = [c for c in silver.columns if c not in lists + texts]
    return plain_names(silver.select(*others, *_text(*texts), *_joined(*lists)))


@query
def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return _silver_view(fx.products(spark, folder))


@query
def silver_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _silver_view(fx.snapshots(spark, folder))


@query
def bronze_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All versions written as tab-separated text and read back."""
    path = f"{scratch_folder(spark)}/dump"
    fx.versions(spark, folder).drop(*fx.TIE_BREAKERS, "ship_date").write.options(
        header=True, sep="\t", escape='"'
    ).csv(path)
    return plain_names(readers.read_bronze(spark, path))


@query
def quarantine_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A dump with broken lines: what was parsed, and what was set aside for which reason."""
    path = scratch_folder(spark)
    fx.write_dump(fx.dump_lines(spark, folder), f"{path}/dump")
    quarantine.store_lines(spark, f"{path}/dump", f"{path}/lines")
    good = quarantine.good_lines(spark, f"{path}/lines").select(*fx.DUMP_HEADER)
    broken = quarantine.broken_lines(spark, f"{path}/lines").select("reason", "line")
    return good.unionByName(broken, allowMissingColumns=True)


@query
def sample_csv_view(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/products"
    sinks.write_parquet(fx.products(spark, folder), path)
    sample = sinks.csv_sample(readers.read_silver(spark, path), "code", 200)
    return plain_names(sample.withColumns({c: F.col(c).cast("string") for c in ("last_modified_ts", "event_date")}))


# --- star ---------------------------------------------------------------------------------------


@query
def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    rows = star_plan.dim_time(fx.snapshots(spark, folder))
    return rows.withColumn("date", F.col("date").cast("string"))


@query
def dim_brand(spark: SparkSession, folder: str) -> DataFrame:
    return star_plan.dim_brand(fx.products(spark, folder)).select("brand_name")


@query
def dim_category(spark: SparkSession, folder: str) -> DataFrame:
    rows = star_plan.dim_category(fx.products(spark, folder))
    return rows.select("category_code", "category_name_fr", "level")


@query
def dim_category_all(spark: SparkSession, folder: str) -> DataFrame:
    return star_plan.dim_category(fx.products(spark, folder), "all").select("category_code")


@query
def dim_category_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Levels and parents from the lists on the newest products."""
    levels = star_plan.dim_category_levels(fx.products(spark, folder), Workspace(spark, scratch_folder(spark)))
    parent = levels.select(F.col("category_sk").alias("parent_category_sk"), F.col("category_code").alias("parent_code"))
    return levels.join(parent, "parent_category_sk", "left").select("category_code", "level", "parent_code")


@query
def audit_parent_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Parents that are missing once a top category is gone, and the categories below them."""
    levels = star_plan.dim_category_levels(fx.products(spark, folder), Workspace(spark, scratch_folder(spark)))
    left = levels.where(F.col("category_code") != "promo")
    found = audit.orphan_keys(left, "parent_category_sk", left, "category_sk")
    return found.agg(F.count(F.lit(1)).alias("n_parents"), F.sum("n").alias("n_categories"))


def _category_parents(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark, scratch_folder(spark))
    return work.store(hierarchy.category_parents(fx.category_lists(spark, folder), "codes", work), "tree")


@query
def category_ancestors(spark: SparkSession, folder: str) -> DataFrame:
    """Deep lists, some of them the wrong way round."""
    return hierarchy.category_ancestors(_category_parents(spark, folder))


@query
def category_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and quantity of each category with all below it, by return flag."""
    lists = fx.category_lists(spark, folder).select("p_partkey", F.get("codes", F.size("codes") - 1).alias("category"))
    lines = fx.table(spark, folder, "lineitem").join(lists, F.col("l_partkey") == F.col("p_partkey"))
    report = lines.groupBy("category", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity")
    )
    above = hierarchy.category_ancestors(_category_parents(spark, folder))
    found = hierarchy.rolled_up(report, "category", above, ["n", "quantity"], ["l_returnflag"])
    return found.withColumn("quantity", F.col("quantity").cast("double"))


@query
def dim_country(spark: SparkSession, folder: str) -> DataFrame:
    return star_plan.dim_country(fx.products(spark, folder)).select("country_code", "country_name_fr")


def _product_view(product: DataFrame, brand: DataFrame, category: DataFrame) -> DataFrame:
    codes = category.select(F.col("category_sk").alias("primary_category_sk"), "category_code")
    return (
        product.join(brand, "brand_sk", "left")
        .join(codes, "primary_category_sk", "left")
        .select(
            "code",
            "product_name",
            "brand_name",
            "category_code",
            "countries_multi",
            *_text("effective_from"),
            F.date_format("effective_to", "yyyy-MM-dd").alias("effective_to"),
            "is_current",
        )
    )


@query
def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    """Derived keys, resolved against the dimensions."""
    s = fx.star(spark, folder, "dim_product", "dim_brand", "dim_category")
    return _product_view(s["dim_product"], s["dim_brand"], s["dim_category"])


@query
def dim_product_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Keys looked up in the dimensions."""
    silver = fx.products(spark, folder)
    brand, category = star_plan.dim_brand(silver), star_plan.dim_category(silver)
    return _product_view(star_plan.dim_product(silver, brand, category), brand, category)


def _bridge_view(bridge: DataFrame, product: DataFrame, category: DataFrame) -> DataFrame:
    named = bridge.join(product.select("product_sk", "code"), "product_sk")
    return named.join(category, "category_sk").select("code", "category_code")


@query
def bridge_primary(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _BRIDGE, "dim_product", "dim_category")
    return _bridge_view(s[_BRIDGE], s["dim_product"], s["dim_category"])


@query
def bridge_all(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _BRIDGE, "dim_product", "dim_category", categories="all")
    return _bridge_view(s[_BRIDGE], s["dim_product"], s["dim_category"])


def _fact_view(fact: DataFrame, product: DataFrame) -> DataFrame:
    return fact.join(product.select("product_sk", "code"), "product_sk").drop("product_sk")


@query
def fact_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product")
    return _fact_view(s[_FACT], s["dim_product"])


@query
def fact_snapshot_lookup(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, "dim_product", "dim_time")
    looked_up = star_plan.fact_nutrition_snapshot(
        fx.snapshots(spark, folder), s["dim_product"], s["dim_time"]
    )
    return _fact_view(looked_up, s["dim_product"])


@query
def unresolved_facts(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.unresolved_facts(fx.snapshots(spark, folder))


# --- incremental load ---------------------------------------------------------------------------


def _loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Facts of the versions up to the cut, and facts of all versions."""
    rows = fx.versions(spark, folder)
    first, every = (
        star_plan.fact_nutrition_snapshot(S.silver_products(v, fx.SNAPSHOT_KEYS, fx.TIE_BREAKERS))
        for v in (rows.where(F.col("ship_date") < CUT), rows)
    )
    return first, every


def _load_view(fact: DataFrame, products: DataFrame) -> DataFrame:
    named = star_plan.dim_product(products).select("product_sk", "code")
    return fact.join(named, "product_sk").select("code", "time_sk", "sugars_100g", "completeness_score")


@query
def append_no_dupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads: the second adds only facts whose product and date are new."""
    first, every = _loads(spark, folder)
    keys = LOAD_KEYS[_FACT]
    loaded = first.unionByName(unseen_rows(every, first, keys))
    return _load_view(loaded, fx.products(spark, folder))


@query
def append_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored loads into a stored table, the second one twice."""
    scratch = scratch_folder(spark)
    target = ParquetTable(f"{scratch}/{_FACT}", GOLD[_FACT])
    for number, rows in enumerate(_loads(spark, folder)):
        sinks.write_parquet(rows, f"{scratch}/load{number}")
    for number in (0, 1, 1):
        append_no_dupe(spark.read.parquet(f"{scratch}/load{number}"), target, LOAD_KEYS[_FACT])
    return _load_view(target.read(spark), fx.products(spark, folder))


# --- stored jobs -------------------------------------------------------------------------------


def _gold_job(spark: SparkSession, folder: str):
    """Silver with several dates per code, stored, and the star loaded from it."""
    scratch = scratch_folder(spark)
    jobs.write_silver(fx.snapshots(spark, folder), f"{scratch}/silver")
    results = jobs.run_gold(spark, f"{scratch}/silver/products", jobs.parquet_tables(f"{scratch}/gold"))
    return results, jobs.stored_star(spark, f"{scratch}/gold")


@query
def gold_job_products(spark: SparkSession, folder: str) -> DataFrame:
    _, s = _gold_job(spark, folder)
    return _product_view(s["dim_product"], s["dim_brand"], s["dim_category"])


@query
def gold_job_bridge(spark: SparkSession, folder: str) -> DataFrame:
    _, s = _gold_job(spark, folder)
    return _bridge_view(s[_BRIDGE], s["dim_product"], s["dim_category"])


@query
def gold_job_fact(spark: SparkSession, folder: str) -> DataFrame:
    _, s = _gold_job(spark, folder)
    return _fact_view(s[_FACT], s["dim_product"])


@query
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What the load reports for each table."""
    results, _ = _gold_job(spark, folder)
    rows = [(name, r.inserted, r.rejected) for name, r in results.items()]
    return spark.createDataFrame(rows, "table_name string, inserted long, rejected long")


@query
def load_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """What the load reports for the fact when codes and dates are missing."""
    scratch = scratch_folder(spark)
    sinks.write_parquet(fx.gapped_snapshots(spark, folder), f"{scratch}/silver")
    results = jobs.run_gold(spark, f"{scratch}/silver", jobs.parquet_tables(f"{scratch}/gold"))
    fact = results[_FACT]
    unresolved = jobs.unresolved_facts(readers.read_silver(spark, f"{scratch}/silver"))
    return unresolved.select(F.lit(fact.inserted).cast("long").alias("inserted"), F.lit(fact.rejected).cast("long").alias("rejected"), "*")


@query
def silver_job_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The stored metrics record of the silver job, read back."""
    scratch = scratch_folder(spark)
    jobs.write_silver(fx.products(spark, folder), scratch)
    stored = spark.read.schema(jobs.METRICS).json(f"{scratch}/metrics")
    metrics = audit.silver_checks(stored.drop("run_ts", "columns"))
    return metrics.withColumn("avg_completeness_score", F.round("avg_completeness_score", 9))


# --- reports ------------------------------------------------------------------------------------


@query
def report_brand_grade_share(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product", "dim_brand")
    return reports.top_brands_by_grade(s[_FACT], s["dim_product"], s["dim_brand"])


@query
def report_grade_by_category(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product", "dim_category")
    return reports.grade_by_category(s[_FACT], s["dim_product"], s["dim_category"])


@query
def report_sugar_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product", "dim_category")
    return reports.sugar_by_category_and_country(s[_FACT], s["dim_product"], s["dim_category"])


@query
def report_brand_completeness(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product", "dim_brand")
    return reports.completeness_by_brand(s[_FACT], s["dim_product"], s["dim_brand"])


@query
def report_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product", "dim_category")
    return reports.anomalies(s[_FACT], s["dim_product"], s["dim_category"])


@query
def report_weekly_completeness(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_time")
    return reports.weekly_completeness(s[_FACT], s["dim_time"])


@query
def report_weekly_completeness_iso_year(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_time")
    return reports.weekly_completeness(s[_FACT], s["dim_time"], "iso_year")


def _laid_out(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Fact and products laid out in files, and the stored dates. Fact and dates come from the same snapshots, which are made once."""
    scratch = scratch_folder(spark)
    place = layout.LaidOut(f"{scratch}/gold", buckets=8)
    with Workspace(spark, scratch) as work:
        s = fx.star(spark, folder, "dim_product", _FACT, "dim_time", work=work)
        place.write(s[_FACT], s["dim_product"])
        sinks.write_parquet(s["dim_time"], f"{scratch}/dim_time")
    return place.open(spark), spark.read.schema(GOLD["dim_time"]).parquet(f"{scratch}/dim_time")


@query
def report_weekly_completeness_span(spark: SparkSession, folder: str) -> DataFrame:
    """The weeks around a New Year; only the files of these two years are read."""
    s, time = _laid_out(spark, folder)
    days = time.where("date between date'1995-11-06' and date'1996-02-25'")
    return reports.weekly_completeness(layout.dated(s[_FACT], days), days)


@query
def report_brand_grade_share_laid_out(spark: SparkSession, folder: str) -> DataFrame:
    """The fact meets the products in the buckets it is stored in."""
    s, _ = _laid_out(spark, folder)
    brand = fx.star(spark, folder, "dim_brand")["dim_brand"]
    return reports.top_brands_by_grade(s[_FACT], s["dim_product"], brand)


@query
def report_least_complete_categories(spark: SparkSession, folder: str) -> DataFrame:
    s = fx.star(spark, folder, _FACT, "dim_product", "dim_category")
    return reports.least_complete_categories(s[_FACT], s["dim_product"], s["dim_category"])


# --- audits -------------------------------------------------------------------------------------


@query
def audit_unique(spark: SparkSession, folder: str) -> DataFrame:
    return audit.duplicate_keys(fx.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def audit_foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a label."""
    docs, labels = fx.table(spark, folder, "documents"), fx.table(spark, folder, "labels")
    return audit.orphan_keys(docs, "doc_id", labels, "doc_id")


@query
def audit_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return audit.null_counts(fx.versions(spark, folder), list(fx.VERSION_COLUMNS))


@query
def audit_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Raw measures against the bounds."""
    rows = fx.versions(spark, folder)
    parsed = rows.select(*[N.parse_number(F.col(c)).alias(c) for c in N.NUTRIENT_BOUNDS])
    return audit.out_of_bounds_counts(parsed, N.NUTRIENT_BOUNDS)


@query
def audit_lengths(spark: SparkSession, folder: str) -> DataFrame:
    docs = fx.table(spark, folder, "documents")
    return audit.too_long_counts(docs, {"text": 4096, "lang": 64, "source": 4})


@query
def audit_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Lines shipped no later than their order was placed."""
    lines = fx.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return audit.bad_intervals(rows, "o_orderdate", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", *_text("o_orderdate", "l_shipdate")
    )


@query
def audit_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.table_counts(fx.star(spark, folder))


@query
def audit_star(spark: SparkSession, folder: str) -> DataFrame:
    return audit.star_violations(fx.stored_star(spark, folder, scratch_folder(spark)))


@query
def audit_star_broken(spark: SparkSession, folder: str) -> DataFrame:
    """The same checks where something is wrong in each table."""
    return audit.star_violations(fx.broken_star(fx.stored_star(spark, folder, scratch_folder(spark))))


@query
def bronze_vs_silver(spark: SparkSession, folder: str) -> DataFrame:
    bronze, silver = fx.versions(spark, folder), fx.products(spark, folder)
    raw = {c: N.parse_number(F.col(c)) for c in N.NUTRIENT_BOUNDS}
    clean = {c: F.col(c) for c in N.NUTRIENT_BOUNDS}
    profiles = [
        audit.layer_profile(bronze, "bronze", "code", raw, N.NUTRIENT_BOUNDS),
        audit.layer_profile(silver, "silver", "code", clean, N.NUTRIENT_BOUNDS),
    ]
    return plain_names(union_sources(*profiles))


# --- several sources, linkage, history ----------------------------------------------------------

PARTY = T.StructType(
    [
        T.StructField("party_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.IntegerType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("segment", T.StringType()),
    ]
)


@query
def union_of_sources(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: fx.table(spark, folder, name) for name in PARTY_NAMES}
    return union_sources(*(readers.as_source(df, name, PARTY, PARTY_NAMES[name]) for name, df in tables.items()))


PARTY_NAMES = {
    "customer": {"party_id": "c_custkey", "name": "c_name", "nation": "c_nationkey", "balance": "c_acctbal", "segment": "c_mktsegment"},
    "supplier": {"party_id": "s_suppkey", "name": "s_name", "nation": "s_nationkey", "balance": "s_acctbal"},
}


def _through_files(spark: SparkSession, folder: str, write, read) -> DataFrame:
    """Both tables written in a format and read back under the contract."""
    scratch, parts = scratch_folder(spark), []
    for name, mapping in PARTY_NAMES.items():
        rows = fx.table(spark, folder, name).select(*mapping.values())
        write(rows, f"{scratch}/{name}")
        parts.append(read(f"{scratch}/{name}", name, rows.schema, mapping))
    return union_sources(*parts)


@query
def sources_csv(spark: SparkSession, folder: str) -> DataFrame:
    return _through_files(
        spark,
        folder,
        lambda rows, path: rows.write.options(header=True).csv(path),
        lambda path, name, _, mapping: readers.read_csv_source(spark, path, name, PARTY, mapping),
    )


@query
def sources_json(spark: SparkSession, folder: str) -> DataFrame:
    return _through_files(
        spark,
        folder,
        lambda rows, path: rows.write.json(path),
        lambda path, name, layout, mapping: readers.read_json_source(spark, path, name, PARTY, layout, mapping),
    )


@query
def sources_variant(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in two shapes, no layout declared."""
    path = f"{scratch_folder(spark)}/documents"
    fx.party_documents(spark, folder).write.text(path)
    return variants.as_contract(variants.read_documents(spark, path), PARTY, PARTY_PATHS).drop("file")


PARTY_PATHS = {
    "party_id": ["$.id", "$.supplier_id"],
    "name": ["$.party.names[0]", "$.title"],
    "nation": ["$.party.home.nation", "$.nation"],
    "balance": ["$.account.balance", "$.saldo"],
}


@query
def sources_variant_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Names and types that the documents of both shapes hold."""
    path = f"{scratch_folder(spark)}/documents"
    fx.party_documents(spark, folder).write.text(path)
    return variants.document_paths(variants.read_documents(spark, path))


@query
def sources_xml(spark: SparkSession, folder: str) -> DataFrame:
    return _through_files(
        spark,
        folder,
        lambda rows, path: rows.write.options(rowTag="party", rootTag="parties").xml(path),
        lambda path, name, layout, mapping: readers.read_xml_source(spark, path, name, PARTY, layout, "party", mapping),
    )


@query
def fuzzy_linkage(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of one nation whose names are one edit apart."""
    return linkage.fuzzy_pairs(fx.table(spark, folder, "customer"), "c_nationkey", "c_name", 1)


@query
def link_offers(spark: SparkSession, folder: str) -> DataFrame:
    """Best catalogue title for each offered title, up to two edits away."""
    master, offers = fx.catalogue_records(spark, folder), fx.offer_records(spark, folder)
    return linkage.link_to_master(master, offers, "size_block", "title", 2)


@query
def golden_record(spark: SparkSession, folder: str) -> DataFrame:
    master, offers = fx.catalogue_records(spark, folder), fx.offer_records(spark, folder)
    attributes = ["brand", "category", "offer_price"]
    return linkage.golden_records(master, offers, "size_block", "title", "record_id", attributes, 2)


@query
def golden_record_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources; names are linked one edit at a time and links are followed on."""
    sources = [f(spark, folder) for f in (fx.catalogue_records, fx.offer_records, fx.shop_records)]
    attributes = ["brand", "category", "offer_price"]
    work = Workspace(spark, scratch_folder(spark))
    return clusters.golden_clusters(sources, "size_block", "title", "record_id", attributes, 1, work)


@query
def similar_titles_grams(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of two sources that share seven tenths of their letter pairs."""
    records = fx.catalogue_records(spark, folder), fx.offer_records(spark, folder)
    found = similarity.similar_titles(*records, "size_block", "title", threshold=0.7)
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def similar_titles_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of two sources up to four edits apart."""
    records = fx.catalogue_records(spark, folder), fx.offer_records(spark, folder)
    return similarity.similar_titles(*records, "size_block", "title", edits=4)


@query
def similar_customers_grams(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of a nation, whose names are alike but for the number."""
    customers = fx.table(spark, folder, "customer")
    work = Workspace(spark, scratch_folder(spark))
    found = similarity.similar_titles(customers, customers, "c_nationkey", "c_name", threshold=0.9, q=3, work=work)
    return found.where("left_name < right_name").withColumn("similarity", F.round("similarity", 6))


HISTORY_ATTRIBUTES = ("nova_group", "countries")


def _history_view(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("string") for c in ("effective_from", "effective_to")})


@query
def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.versions(spark, folder)
    return _history_view(
        history.version_history(rows, "code", "ship_date", HISTORY_ATTRIBUTES, tie_breakers=fx.TIE_BREAKERS)
    )


@query
def scd2_extend(spark: SparkSession, folder: str) -> DataFrame:
    """History of the first load, extended by the later versions."""
    rows = fx.versions(spark, folder)
    stored = history.version_history(
        rows.where(F.col("ship_date") < CUT), "code", "ship_date", HISTORY_ATTRIBUTES, tie_breakers=fx.TIE_BREAKERS
    )
    late = rows.where(F.col("ship_date") >= CUT)
    extended = history.extend_history(
        stored, late, "code", "ship_date", HISTORY_ATTRIBUTES, tie_breakers=fx.TIE_BREAKERS
    )
    return _history_view(extended)


@query
def fact_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with the version of the product that was valid at their date."""
    kept = history.version_history(
        fx.versions(spark, folder), "code", "ship_date", HISTORY_ATTRIBUTES, tie_breakers=fx.TIE_BREAKERS
    )
    # Versions without a code are in no fact. Left out like the products without one, they all come from the same exchanges.
    kept = kept.where(X.is_filled(F.col("code")))
    fact = star_plan.fact_with_versions(fx.snapshots(spark, folder), kept)
    product = star_plan.dim_product(fx.products(spark, folder)).select("product_sk", "code")
    named = kept.select(
        star_plan.version_key(F.col("code"), F.col("effective_from")).alias("version_sk"),
        F.col("nova_group").alias("version_group"),
        "countries",
        F.col("effective_from").cast("string").alias("effective_from"),
    )
    rows = fact.join(product, "product_sk").join(named, "version_sk", "left")
    return rows.select("code", "time_sk", "sugars_100g", "nova_group", "version_group", "countries", "effective_from")
