"""Silver table to dimensions, bridge and fact.

A surrogate key is a function of its natural key, so rows built from the same silver table find
their parents' keys without a join: product, bridge and fact come out of one narrow stage. Pass
the stored dimensions to look the keys up there instead, which also drops rows without a parent.
A lookup joins many rows with a table that holds each key once; if one key dominates, adaptive
execution splits its partition, and a dimension measured as small is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import keys as K
from larder.functions import text as X
from larder.operators import asof, hierarchy
from larder.operators.columns import conform, plain_names
from larder.operators.dedup import distinct_keys, keep_latest
from larder.schemas import (
    BRIDGE_PRODUCT_CATEGORY,
    DIM_BRAND,
    DIM_CATEGORY,
    DIM_COUNTRY,
    DIM_PRODUCT,
    DIM_TIME,
    FACT_NUTRITION_SNAPSHOT,
    GOLD,
    NUTRIENT_COLUMNS,
    SILVER,
)
from larder.sources.workspace import Workspace


# What dimensions and bridge need of a silver row; the last two settle which row of a code is the newest.
PRODUCT_COLUMNS = (
    "code",
    "product_name_pref",
    "brand_primary",
    "primary_category_code",
    "categories_codes",
    "country_primary_code",
    "countries_codes",
    "event_date",
    "last_modified_ts",
)

# What time and fact need of a silver row.
SNAPSHOT_COLUMNS = (
    *("code", "event_date", *NUTRIENT_COLUMNS, "nutriscore_grade", "nova_group", "ecoscore_grade"),
    *("completeness_score", "quality_issues_json"),
)


def newest_products(silver: DataFrame) -> DataFrame:
    """Newest row of each code, in the columns that dimensions and bridge need: the scan reads no others, and no others are
    hashed to settle ties."""
    rows = conform(silver, SILVER).select(*PRODUCT_COLUMNS)
    return keep_latest(rows, ["code"], F.col("last_modified_ts"), ["event_date"])


def category_codes() -> Column:
    """All categories of a product in canonical form, each once."""
    codes = F.transform(F.col("categories_codes"), X.canonical)
    return F.filter(F.array_distinct(codes), X.is_filled)


def _with_brand_name(rows: DataFrame) -> DataFrame:
    # One step per column: an expression used several times by the next one is then computed once.
    kept = rows.withColumn("brand_name", X.noise_to_null(F.col("brand_primary")))
    named = kept.withColumn("brand_name", X.canonical(F.col("brand_name")))
    return named.withColumn("brand_name", X.blank_to_null(F.col("brand_name")))


def _with_category_code(rows: DataFrame) -> DataFrame:
    coded = rows.withColumn("category_code", X.canonical(F.col("primary_category_code")))
    return coded.withColumn("category_code", X.blank_to_null(F.col("category_code")))


def _with_country_code(rows: DataFrame) -> DataFrame:
    coded = rows.withColumn("country_code", X.canonical(F.col("country_primary_code")))
    return coded.withColumn("country_code", X.blank_to_null(F.col("country_code")))


def _distinct_values(
    silver: DataFrame, column: str, make: Callable[[DataFrame], DataFrame], name: str, raw: Column | None = None
) -> DataFrame:
    """Distinct canonical values: distinct as stored first, so each spelling is treated once.

    The value is tied to its number of uses. Without that tie, a later filter on the canonical form
    would be pushed below the first aggregate and compute it for every row there.
    """
    values = conform(silver, SILVER).select((F.col(column) if raw is None else raw).alias(column))
    spellings = values.groupBy(column).agg(F.count(F.lit(1)).alias("uses"))
    tied = spellings.withColumn(column, F.when(F.col("uses") > 0, F.col(column)))
    return distinct_keys(make(tied), F.col(name)).where(F.col(name).isNotNull())


def dim_time(silver: DataFrame) -> DataFrame:
    dates = distinct_keys(conform(silver, SILVER), F.col("event_date").alias("date"))
    day = F.col("date")
    iso_week = F.weekofyear(day)
    return dates.select(
        K.date_key(day).alias("time_sk"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        iso_week.alias("week"),
        iso_week.alias("iso_week"),
        F.extract(F.lit("YEAROFWEEK"), day).cast("int").alias("iso_year"),
    ).where(F.col("time_sk").isNotNull())


def dim_brand(silver: DataFrame) -> DataFrame:
    names = _distinct_values(silver, "brand_primary", _with_brand_name, "brand_name")
    return conform(names.withColumn("brand_sk", K.surrogate_key(F.col("brand_name"))), DIM_BRAND)


def dim_category(silver: DataFrame, categories: str = "primary") -> DataFrame:
    """Categories that are some product's first one, or all that occur."""
    if categories not in ("primary", "all"):
        raise ValueError(f"unknown category choice: {categories}")
    raw = F.explode("categories_codes") if categories == "all" else None
    codes = _distinct_values(silver, "primary_category_code", _with_category_code, "category_code", raw)
    return conform(codes.withColumn("category_sk", K.surrogate_key(F.col("category_code"))), DIM_CATEGORY)


def dim_category_levels(silver: DataFrame, work: Workspace) -> DataFrame:
    """All categories with level and parent, from the order of the lists on products; 1 is the top level."""
    lists = conform(silver, SILVER).select(category_codes().alias("codes"))
    parents = hierarchy.category_parents(lists, "codes", work)
    levels = hierarchy.category_levels(parents, hierarchy.category_ancestors(parents))
    return conform(
        levels.select(
            K.surrogate_key(F.col("code")).alias("category_sk"),
            F.col("code").alias("category_code"),
            "level",
            K.surrogate_key(F.col("parent")).alias("parent_category_sk"),
        ),
        DIM_CATEGORY,
    )


def dim_country(silver: DataFrame) -> DataFrame:
    codes = _distinct_values(silver, "country_primary_code", _with_country_code, "country_code")
    return conform(codes.withColumn("country_sk", K.surrogate_key(F.col("country_code"))), DIM_COUNTRY)


def dim_product(
    silver: DataFrame, brand: DataFrame | None = None, category: DataFrame | None = None
) -> DataFrame:
    """One row per silver row with a code; the silver table holds each code once."""
    rows = conform(silver, SILVER).where(X.is_filled(F.col("code")))
    rows = _with_category_code(_with_brand_name(rows)).select(
        K.surrogate_key(F.col("code")).alias("product_sk"),
        "code",
        F.col("product_name_pref").alias("product_name"),
        "brand_name",
        "category_code",
        F.to_json("countries_codes").alias("countries_multi"),
        F.col("event_date").cast("timestamp").alias("effective_from"),
        F.lit(K.OPEN_END).cast("timestamp").alias("effective_to"),
        F.lit(1).alias("is_current"),
    )
    if brand is None:
        rows = rows.withColumn("brand_sk", K.surrogate_key(F.col("brand_name")))
    else:
        rows = rows.join(brand.select("brand_name", "brand_sk"), "brand_name", "left")
    if category is None:
        rows = rows.withColumn("primary_category_sk", K.surrogate_key(F.col("category_code")))
    else:
        known = category.select("category_code", F.col("category_sk").alias("primary_category_sk"))
        rows = rows.join(known, "category_code", "left")
    return conform(rows, DIM_PRODUCT)


def product_category_pairs(silver: DataFrame) -> DataFrame:
    """All (product, category) pairs; each pair once, as the silver table holds each code once."""
    rows = conform(silver, SILVER).where(X.is_filled(F.col("code")))
    pairs = rows.select(
        K.surrogate_key(F.col("code")).alias("product_sk"),
        F.explode(category_codes()).alias("category_code"),
    )
    return pairs.withColumn("category_sk", K.surrogate_key(F.col("category_code")))


def bridge_product_category(
    silver: DataFrame,
    category: DataFrame | None = None,
    product: DataFrame | None = None,
    categories: str = "primary",
) -> DataFrame:
    """Product-category pairs whose category is in the dimension.

    Without a stored dimension, ``primary`` keeps categories that are the first of some product
    and ``all`` keeps every pair, which needs no join at all.
    """
    pairs = product_category_pairs(silver)
    if category is None and categories == "primary":
        category = dim_category(silver)
    if category is not None:
        pairs = pairs.join(category.select("category_sk"), "category_sk", "left_semi")
    if product is not None:
        pairs = pairs.join(product.select("product_sk"), "product_sk", "left_semi")
    if category is not None or product is not None:
        # Else what follows may keep the partitioning of the join, which has a hot category in one task.
        pairs = pairs.repartition("product_sk", "category_sk")
    return conform(pairs, BRIDGE_PRODUCT_CATEGORY)


def fact_rows(
    silver: DataFrame, product: DataFrame | None = None, time: DataFrame | None = None
) -> DataFrame:
    """Every silver row in the layout of the fact; keys that cannot be resolved are NULL."""
    rows = plain_names(conform(silver, SILVER))
    if product is None:
        rows = rows.withColumn("product_sk", K.surrogate_key(X.blank_to_null(F.col("code"))))
    else:
        rows = rows.join(product.select("code", "product_sk"), "code", "left")
    if time is None:
        rows = rows.withColumn("time_sk", K.date_key(F.col("event_date")))
    else:
        known = time.select(F.col("date").alias("event_date"), "time_sk")
        rows = rows.join(known, "event_date", "left")
    return conform(rows, FACT_NUTRITION_SNAPSHOT)


def fact_nutrition_snapshot(
    silver: DataFrame, product: DataFrame | None = None, time: DataFrame | None = None
) -> DataFrame:
    """Measures per product and date. Rows without a product or a date are left out."""
    if product is None:
        # Keys are made of the code then. Asked as the product dimension asks, so that both can come from one exchange.
        return fact_rows(conform(silver, SILVER).where(X.is_filled(F.col("code"))), None, time).dropna(subset=["time_sk"])
    return fact_rows(silver, product, time).dropna(subset=["product_sk", "time_sk"])


def build_star(
    products: DataFrame,
    snapshots: DataFrame | None = None,
    categories: str = "primary",
    names: Iterable[str] = GOLD,
    unresolved: bool = False,
) -> dict[str, DataFrame]:
    """Gold tables by name, parents first; all of them unless ``names`` says otherwise.

    ``products`` holds one row per code. ``snapshots`` may hold several dates per code and defaults
    to the same rows. With ``unresolved`` the fact keeps the rows whose keys are missing, for a load that counts
    and rejects them.
    """
    snapshots = products if snapshots is None else snapshots
    makers = {
        "dim_time": lambda: dim_time(snapshots),
        "dim_brand": lambda: dim_brand(products),
        "dim_category": lambda: dim_category(products, categories),
        "dim_country": lambda: dim_country(products),
        "dim_product": lambda: dim_product(products),
        "bridge_product_category": lambda: bridge_product_category(products, categories=categories),
        "fact_nutrition_snapshot": lambda: (fact_rows if unresolved else fact_nutrition_snapshot)(snapshots),
    }
    return {name: makers[name]() for name in names}


def version_key(code: Column, begin: Column) -> Column:
    """Key of one version of a product: of its code and the day it begins."""
    return K.surrogate_key(F.when(code.isNotNull() & begin.isNotNull(), F.concat(code, F.lit("|"), begin.cast("date").cast("string"))))


def fact_with_versions(silver: DataFrame, history: DataFrame) -> DataFrame:
    """The fact with ``version_sk``: the version of the product (a row of ``history`` by ``code``) that was valid at the fact's date."""
    values = {"version_sk": version_key(F.col("code"), F.col("effective_from"))}
    keys = {"product_sk": K.surrogate_key(X.blank_to_null(F.col("code"))), "time_sk": K.date_key(F.col("event_date"))}
    # Rows without a place in the fact go first, so that rows and the days asked for can come from one and the same exchange.
    placed = conform(silver, SILVER).where(X.is_filled(F.col("code")) & keys["time_sk"].isNotNull())
    rows = asof.with_version(placed, history, "code", "event_date", values)
    keyed = plain_names(rows).withColumns(keys)
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in FACT_NUTRITION_SNAPSHOT.fields], "version_sk")
