"""Messy product versions and the star, derived from the order tables.

Each line item stands for one recorded version of the product it sells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.plans.silver import silver_products
from larder.plans.star import SNAPSHOT_COLUMNS, build_star
from larder.schemas import GOLD
from larder.sources.workspace import Workspace

TIE_BREAKERS = ("l_orderkey", "l_linenumber", "l_suppkey")
SNAPSHOT_KEYS = ("code", "event_date")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Output column -> SQL expression. The same text runs on Spark and on the checking engine.
VERSION_COLUMNS = {
    "code": "lpad(cast(l_partkey as varchar(20)), 13, '0')",
    "product_name_fr": "case when p_size % 4 = 0 then concat(p_name, ' FR') end",
    "product_name": "case when p_size % 9 = 0 then '' else p_name end",
    "product_name_en": "concat(p_name, ' EN')",
    "brands": (
        "case when p_size % 11 = 0 then 'Unknown' when p_size % 13 = 0 then '12345' "
        "when p_size % 3 = 0 then concat('0; ', upper(p_brand), '  Foods,n/a') "
        "else concat('Crème ', p_brand, ';Other') end"
    ),
    "categories_tags": (
        "case when p_size % 7 = 0 then null "
        "else concat('en:', lower(p_type), ',fr:', replace(p_name, ' ', '-'), ',en:,77') end"
    ),
    "categories": "concat(p_type, ' ; ', p_name)",
    "countries_tags": (
        "case when l_linenumber = 7 then null "
        "else concat('en:', lower(replace(n_name, '_', '-')), ',en:world') end"
    ),
    "countries": "n_name",
    "nutriscore_grade": (
        "case when p_size % 6 = 0 then 'UNKNOWN' else substr('ABCDE', cast(p_size % 5 as int) + 1, 1) end"
    ),
    "nova_group": "cast(l_linenumber % 4 + 1 as varchar(4))",
    "last_modified_t": "case when p_size % 17 = 0 then null else cast(cast({epoch} as bigint) as varchar(20)) end",
    "energy-kcal_100g": (
        "case when l_linenumber = 6 then null "
        "else replace(cast(cast(l_quantity * 20 as decimal(10, 2)) as varchar(20)), '.', ',') end"
    ),
    "energy_100g": "cast(cast(l_quantity * 30 as decimal(10, 2)) as varchar(20))",
    "sugars_100g": "cast(cast(l_quantity * 2.2 as decimal(10, 2)) as varchar(20))",
    "salt_100g": (
        "case when l_linenumber = 5 then 'abc' "
        "else cast(cast(l_discount * 300 as decimal(10, 2)) as varchar(20)) end"
    ),
    "fat_100g": "cast(cast(l_tax * 100 - 2 as decimal(10, 2)) as varchar(20))",
    "proteins_100g": "cast(cast(l_quantity as decimal(10, 2)) as varchar(20))",
}

# Raw columns that the expressions above use, and the number of versions that one task expands: a version takes some 600 bytes.
LINE_COLUMNS = ("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
RAW_COLUMNS = (*LINE_COLUMNS, "p_name", "p_brand", "p_type", "p_size", "n_name")
VERSIONS_PER_TASK = 200_000

BUCKETS_PER_TASK = 16

SPARK_EPOCH = "unix_timestamp(cast(l_shipdate as timestamp))"


def _line_counts(lines: DataFrame, most: int) -> tuple[int, bool]:
    """Number of line items, and whether a part has more than ``most`` of them.

    Parts are counted in buckets of a hash first, a few numbers a task; each by itself only if a bucket is too full.
    """
    known = lines.where(F.col("l_partkey").isNotNull())
    n = known.count()
    if n <= most:
        return n, False
    bucket = F.pmod(F.xxhash64("l_partkey"), F.lit(-(-n // most) * BUCKETS_PER_TASK))
    for key in (bucket, F.col("l_partkey")):
        largest = known.groupBy(key.alias("bucket")).count().agg(F.max("count")).first()[0] or 0
        if largest <= most:
            return n, False
    return n, True


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """All product versions, one per line item.

    They are spread before they are expanded. A stored line item takes some twenty bytes, so a task with a whole split of the file, or with a
    partition that was sized by its compressed rows, would sort far more than its memory holds later on. Line items are spread by their product's
    code, narrow as they are, and parts likewise, so neither the join with large parts nor what groups or sorts the wide rows of a code
    needs another exchange. Suppliers are joined before that, since a join by another key would undo it. Where the session
    wants rows spread by all keys of a join, part numbers do; a part that fills a task by itself is spread after the joins, by all keys.
    """
    lines = table(spark, folder, "lineitem").select(*LINE_COLUMNS)
    part, supplier, nation = (table(spark, folder, name) for name in ("part", "supplier", "nation"))
    n, hot = _line_counts(lines, VERSIONS_PER_TASK)
    tasks = -(-n // VERSIONS_PER_TASK)
    of_part, of_supplier = F.col("l_partkey") == F.col("p_partkey"), F.col("l_suppkey") == F.col("s_suppkey")
    if tasks > 1 and not hot:
        lines = lines.where(F.col("l_partkey").isNotNull())
        if spark.conf.get("spark.sql.requireAllClusterKeysForDistribution") == "true":
            lines = lines.repartition(tasks, "l_partkey").join(part, of_part).join(supplier, of_supplier)
        else:
            code, part_code = (F.expr(VERSION_COLUMNS["code"].replace("l_partkey", key)) for key in ("l_partkey", "p_partkey"))
            lines = lines.join(supplier.select("s_suppkey", "s_nationkey"), of_supplier)
            # Codes are cut at 13 digits, so the numbers are compared too; as a second key of the join they would call for another exchange.
            same_number = F.col("l_partkey").between(F.col("p_partkey"), F.col("p_partkey"))
            lines = lines.repartition(tasks, code).join(part.repartition(tasks, part_code), (code == part_code) & same_number)
    else:
        lines = lines.join(part, of_part).join(supplier, of_supplier)
    joined = lines.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    if tasks > 1 and hot:
        joined = joined.select(*RAW_COLUMNS).repartition(tasks, *TIE_BREAKERS, "l_partkey", "l_shipdate")
    columns = [F.expr(sql.format(epoch=SPARK_EPOCH)).alias(name) for name, sql in VERSION_COLUMNS.items()]
    return joined.select(*columns, *TIE_BREAKERS, F.to_date("l_shipdate").alias("ship_date"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Clean products, newest version of each."""
    return silver_products(versions(spark, folder), tie_breakers=TIE_BREAKERS)


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Clean products, newest version per product and date."""
    return silver_products(versions(spark, folder), SNAPSHOT_KEYS, TIE_BREAKERS)


def star(
    spark: SparkSession, folder: str, *names: str, categories: str = "primary", work: Workspace | None = None
) -> dict[str, DataFrame]:
    """Gold tables from the product versions, all of them unless names are given.

    With ``work`` the snapshots are stored there, in the columns that fact and dates need, and read by both.
    """
    rows = versions(spark, folder)
    snapshots = silver_products(rows, SNAPSHOT_KEYS, TIE_BREAKERS, sources_first=True)
    if work:
        snapshots = work.store(snapshots.select(*SNAPSHOT_COLUMNS), "snapshots")
    return build_star(
        silver_products(rows, tie_breakers=TIE_BREAKERS, sources_first=True),
        snapshots,
        categories,
        names or GOLD,
    )


def stored_star(spark: SparkSession, folder: str, scratch: str) -> dict[str, DataFrame]:
    """Gold tables, written under ``scratch`` and read back."""
    for name, silver in {"products": products(spark, folder), "snapshots": snapshots(spark, folder)}.items():
        silver.write.parquet(f"{scratch}/{name}")
    stored = [spark.read.parquet(f"{scratch}/{name}") for name in ("products", "snapshots")]
    for name, rows in build_star(*stored, "primary", GOLD).items():
        rows.write.parquet(f"{scratch}/star/{name}")
    return {name: spark.read.schema(GOLD[name]).parquet(f"{scratch}/star/{name}") for name in GOLD}


# What is broken in each table: rows that go, columns that change, and rows that come twice, with columns changed in the copies.
# Conditions and values are the same text on both engines.
GONE = {
    "dim_time": "month = 2",
    "dim_brand": "brand_name like '%3%'",
    "dim_category": "category_code like 'e%'",
    "dim_product": "code like '%5'",
}
CHANGED = {
    "dim_time": {},
    "dim_brand": {
        "brand_name": "case when brand_name like '%1%' then null when brand_name like '%2%' then repeat(brand_name, 100) else brand_name end"
    },
    "dim_category": {"category_name_fr": "case when category_code like '%s' then repeat('n', 501) end"},
    "dim_country": {},
    "dim_product": {
        "product_name": "case when code like '%4' then repeat(concat(product_name, '-'), 2000) else product_name end",
        "effective_to": "case when code like '%7' then effective_from else {end} end",
        "is_current": "case when code like '%8' then null else is_current end",
    },
    "bridge_product_category": {},
    "fact_nutrition_snapshot": {
        "nutriscore_grade": "case when time_sk % 100 = 1 then repeat('A', 65) else nutriscore_grade end",
        "nova_group": "case when time_sk % 100 = 4 then repeat('1', 65) else nova_group end",
    },
}
TWICE = {
    "dim_time": ("month = 3", {"iso_week": "null"}),
    "dim_country": ("country_code like '%a%'", {"country_code": "null"}),
    "dim_category": ("category_code like '%l%'", {}),
    "dim_product": ("code like '%2'", {"code": "concat('x', code)"}),
    "bridge_product_category": ("{number} % 10 = 1", {}),
    "fact_nutrition_snapshot": ("time_sk % 100 = 3", {}),
}


def broken_star(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with faults of every kind, surrogate keys as they were; categories point to themselves or nowhere."""
    broken = {}
    # The surrogate key says nothing, so pairs are chosen by the code of their product.
    codes = star["dim_product"].select("product_sk", F.expr("cast(code as bigint)").alias("__number"))
    for name, rows in star.items():
        if name == "bridge_product_category":
            rows = rows.join(codes, "product_sk")
        if name in GONE:
            rows = rows.where(f"not ({GONE[name]})")
        if name in TWICE:
            condition, changes = TWICE[name]
            copies = rows.where(condition.format(number="__number"))
            copies = copies.withColumns({c: F.expr(sql).cast(GOLD[name][c].dataType) for c, sql in changes.items()})
            rows = rows.unionAll(copies)
        if name == "dim_category":
            parent = "case when length(category_code) % 3 = 0 then category_sk when length(category_code) % 3 = 1 then -1 end"
            rows = rows.withColumn("parent_category_sk", F.expr(parent))
        changes = {c: F.expr(sql.format(end=c)).cast(GOLD[name][c].dataType) for c, sql in CHANGED[name].items()}
        broken[name] = (rows.withColumns(changes) if changes else rows).select(*GOLD[name].names)
    return broken


# Rows of the stored silver table that lack what the fact needs.
GAPS = {
    "code": "case when code like '%3' then null when code like '%6' then '' else code end",
    "event_date": "case when {code} % 7 = 0 then null else event_date end",
}


def gapped_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    rows = snapshots(spark, folder)
    return rows.withColumns({c: F.expr(sql.format(code="cast(code as bigint)")) for c, sql in GAPS.items()})


# Two sources that name the same things: the part list, and offers whose titles carry typing errors.
CATALOGUE_COLUMNS = {
    "record_id": "cast(p_partkey as varchar(20))",
    "size_block": "p_size",
    "title": "p_name",
    "brand": "case when p_size % 5 = 0 then null else p_brand end",
    "category": "case when p_partkey % 7 < 3 then null else p_type end",
    "offer_price": "cast(null as double)",
}
OFFER_COLUMNS = {
    "record_id": (
        "concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20)), '-', "
        "cast(l_suppkey as varchar(20)), '-', cast(l_partkey as varchar(20)))"
    ),
    "size_block": "p_size",
    "title": (
        "case when l_linenumber = 1 then replace(p_name, 'ol', 'o') "
        "when l_linenumber = 2 then concat(p_name, 's') "
        "when l_linenumber = 3 then concat('Dé', p_name, 'x!') else upper(p_name) end"
    ),
    "brand": "case when l_linenumber = 4 then null else lower(p_brand) end",
    "category": "lower(p_type)",
    "offer_price": "l_extendedprice",
}
# A third source whose titles are further away from the first one than from the second.
SHOP_COLUMNS = {
    "record_id": "concat('shop-', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20)), '-', cast(l_partkey as varchar(20)))",
    "size_block": "p_size",
    "title": (
        "case when l_linenumber = 2 then concat(p_name, 'sz') when l_linenumber = 5 then concat('À ', p_name) "
        "when l_linenumber = 6 then replace(p_name, 'ol', 'u') else p_name end"
    ),
    "brand": "case when l_linenumber = 2 then concat(p_brand, ' shop') else null end",
    "category": "concat('shop ', p_type)",
    "offer_price": "l_extendedprice * 2",
}


def _expressions(columns: dict[str, str]):
    return [F.expr(sql).alias(name) for name, sql in columns.items()]


def catalogue_records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(*_expressions(CATALOGUE_COLUMNS))


def offer_records(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    lines = table(spark, folder, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(*_expressions(OFFER_COLUMNS))


def shop_records(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    lines = table(spark, folder, "lineitem").where("l_quantity < 10").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(*_expressions(SHOP_COLUMNS))


# Lists from the general to the special. Every ninth size has them the wrong way round, every eleventh lacks its second entry.
CATEGORY_LISTS = {
    "first": "lower(p_type)",
    "second": "case when p_size % 11 > 0 then concat(lower(p_type), ' ', substr(p_name, 1, 1)) end",
    "third": "concat(lower(p_type), ' ', substr(p_name, 1, 3))",
    "fourth": "concat(lower(p_type), ' ', p_name)",
}


def category_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``p_partkey`` and ``codes`` of each part."""
    parts = table(spark, folder, "part").select("p_partkey", "p_size", *_expressions(CATEGORY_LISTS))
    codes = F.array_distinct(F.array_compact(F.array(*CATEGORY_LISTS)))
    return parts.select("p_partkey", F.when(F.col("p_size") % 9 == 0, F.reverse(codes)).otherwise(codes).alias("codes"))


# Lines of a dump with four columns, some of them short, long or badly quoted.
DUMP_HEADER = ("code", "product_name", "brands", "countries")
_TAB, _QUOTE = "chr(9)", "chr(34)"
DUMP_LINE = f"""case
  when l_orderkey % 11 = 0 then concat(code, {_TAB}, brands)
  when l_orderkey % 11 = 1 then concat(code, {_TAB}, product_name, {_TAB}, brands, {_TAB}, countries, {_TAB}, 'more')
  when l_orderkey % 11 = 2 then concat(code, {_TAB}, {_QUOTE}, product_name, {_TAB}, brands, {_TAB}, countries)
  when l_orderkey % 11 = 3 then concat(code, {_TAB}, product_name, {_TAB}, {_QUOTE}, brands, {_QUOTE}, 'x', {_TAB}, countries)
  when l_orderkey % 11 = 4 then concat(code, {_TAB}, product_name, {_TAB}, {_QUOTE}, {_QUOTE}, {_QUOTE}, brands, {_QUOTE}, {_QUOTE}, {_TAB}, {_QUOTE}, {_TAB}, countries)
  else concat(code, {_TAB}, product_name, {_TAB}, brands, {_TAB}, countries) end"""


def dump_lines(spark: SparkSession, folder: str) -> DataFrame:
    return versions(spark, folder).select(F.expr(DUMP_LINE).alias("value"))


def write_dump(lines: DataFrame, path: str) -> None:
    """Lines as they are, under the header in each file."""
    raw = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.toDF("\t".join(DUMP_HEADER)).write.options(**raw).csv(path)


# The same parties as two systems would send them: nested and with other names, or flat with numbers as text.
NESTED_DOCUMENT = {
    "id": "c_custkey",
    "party": "named_struct('names', array(c_name, 'alias'), 'home', named_struct('nation', c_nationkey))",
    "account": "named_struct('balance', c_acctbal)",
    "segment": "c_mktsegment",
}
FLAT_DOCUMENT = {
    "supplier_id": "cast(s_suppkey as string)",
    "title": "s_name",
    "nation": "cast(s_nationkey as string)",
    "saldo": "case when s_suppkey % 3 = 0 then 'unknown' else cast(s_acctbal as string) end",
}


def party_documents(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text, one object a line, in two shapes."""
    shapes = {"customer": NESTED_DOCUMENT, "supplier": FLAT_DOCUMENT}
    parts = [
        table(spark, folder, name).select(F.to_json(F.struct(*_expressions(columns))).alias("value"))
        for name, columns in shapes.items()
    ]
    return parts[0].unionAll(parts[1])
