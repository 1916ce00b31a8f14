"""Declared column layouts: bronze names, silver table, seven gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
DOUBLE = T.DoubleType()
INT = T.IntegerType()
LONG = T.LongType()
STRINGS = T.ArrayType(T.StringType())


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# Column names of the source dump.
TEXT_COLUMNS = (
    "code",
    "product_name",
    "product_name_fr",
    "product_name_en",
    "brands",
    "categories",
    "categories_tags",
    "countries",
    "countries_tags",
    "nutriscore_grade",
    "nova_group",
    "ecoscore_grade",
    "last_modified_t",
    "lang",
)
NUTRIENT_COLUMNS = (
    "energy-kcal_100g",
    "energy_100g",
    "fat_100g",
    "saturated-fat_100g",
    "sugars_100g",
    "salt_100g",
    "proteins_100g",
    "fiber_100g",
    "sodium_100g",
)
BRONZE_COLUMNS = TEXT_COLUMNS + NUTRIENT_COLUMNS

BRONZE = T.StructType([T.StructField(name, STRING) for name in BRONZE_COLUMNS])

SILVER = T.StructType(
    [T.StructField(name, STRING) for name in TEXT_COLUMNS]
    + [T.StructField(name, DOUBLE) for name in NUTRIENT_COLUMNS]
    + _fields(
        product_name_pref=STRING,
        last_modified_ts=T.TimestampType(),
        brands_arr=STRINGS,
        brands_clean_arr=STRINGS,
        brand_primary=STRING,
        categories_arr=STRINGS,
        categories_codes=STRINGS,
        primary_category_code=STRING,
        countries_arr=STRINGS,
        countries_codes=STRINGS,
        country_primary_code=STRING,
        event_date=T.DateType(),
        has_name=INT,
        has_brands=INT,
        core_nutrients_count=INT,
        completeness_score=DOUBLE,
        quality_issues_json=STRING,
    ).fields
)

DIM_TIME = _fields(
    time_sk=INT, date=T.DateType(), year=INT, month=INT, day=INT, week=INT, iso_week=INT, iso_year=INT
)
DIM_BRAND = _fields(brand_sk=LONG, brand_name=STRING)
DIM_CATEGORY = _fields(
    category_sk=LONG, category_code=STRING, category_name_fr=STRING, level=INT, parent_category_sk=LONG
)
DIM_COUNTRY = _fields(country_sk=LONG, country_code=STRING, country_name_fr=STRING)
DIM_PRODUCT = _fields(
    product_sk=LONG,
    code=STRING,
    product_name=STRING,
    brand_sk=LONG,
    primary_category_sk=LONG,
    countries_multi=STRING,
    effective_from=T.TimestampType(),
    effective_to=T.TimestampType(),
    is_current=INT,
)
BRIDGE_PRODUCT_CATEGORY = _fields(product_sk=LONG, category_sk=LONG)
FACT_NUTRITION_SNAPSHOT = _fields(
    product_sk=LONG,
    time_sk=INT,
    energy_kcal_100g=DOUBLE,
    energy_100g=DOUBLE,
    fat_100g=DOUBLE,
    saturated_fat_100g=DOUBLE,
    sugars_100g=DOUBLE,
    salt_100g=DOUBLE,
    proteins_100g=DOUBLE,
    fiber_100g=DOUBLE,
    sodium_100g=DOUBLE,
    nutriscore_grade=STRING,
    nova_group=STRING,
    ecoscore_grade=STRING,
    completeness_score=DOUBLE,
    quality_issues_json=STRING,
)

# Parents first: a child row may only be loaded after the rows it points to.
GOLD = {
    "dim_time": DIM_TIME,
    "dim_brand": DIM_BRAND,
    "dim_category": DIM_CATEGORY,
    "dim_country": DIM_COUNTRY,
    "dim_product": DIM_PRODUCT,
    "bridge_product_category": BRIDGE_PRODUCT_CATEGORY,
    "fact_nutrition_snapshot": FACT_NUTRITION_SNAPSHOT,
}

# Columns on which a row counts as already loaded.
LOAD_KEYS = {
    "dim_time": ("time_sk",),
    "dim_brand": ("brand_name",),
    "dim_category": ("category_code",),
    "dim_country": ("country_code",),
    "dim_product": ("code",),
    "bridge_product_category": ("product_sk", "category_sk"),
    "fact_nutrition_snapshot": ("product_sk", "time_sk"),
}

UNIQUE_KEYS = {
    "dim_time": (("time_sk",),),
    "dim_brand": (("brand_sk",),),
    "dim_category": (("category_sk",),),
    "dim_country": (("country_sk",), ("country_code",)),
    "dim_product": (("product_sk",), ("code",)),
    "bridge_product_category": (("product_sk", "category_sk"),),
    "fact_nutrition_snapshot": (("product_sk", "time_sk"),),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("dim_product", "brand_sk", "dim_brand", "brand_sk"),
    ("dim_product", "primary_category_sk", "dim_category", "category_sk"),
    ("bridge_product_category", "product_sk", "dim_product", "product_sk"),
    ("bridge_product_category", "category_sk", "dim_category", "category_sk"),
    ("fact_nutrition_snapshot", "product_sk", "dim_product", "product_sk"),
    ("fact_nutrition_snapshot", "time_sk", "dim_time", "time_sk"),
    ("dim_category", "parent_category_sk", "dim_category", "category_sk"),
)

REQUIRED = {
    "dim_time": ("time_sk", "date", "year", "month", "day", "week", "iso_week"),
    "dim_brand": ("brand_sk", "brand_name"),
    "dim_category": ("category_sk", "category_code"),
    "dim_country": ("country_sk", "country_code"),
    "dim_product": ("product_sk", "code", "effective_from", "effective_to", "is_current"),
    "bridge_product_category": ("product_sk", "category_sk"),
    "fact_nutrition_snapshot": ("product_sk", "time_sk"),
}

# Longest text each column of the target tables takes.
MAX_LENGTHS = {
    "dim_brand": {"brand_name": 500},
    "dim_category": {"category_code": 500, "category_name_fr": 500},
    "dim_country": {"country_code": 255, "country_name_fr": 255},
    "dim_product": {"code": 255, "product_name": 4096},
    "fact_nutrition_snapshot": {"nutriscore_grade": 64, "nova_group": 64, "ecoscore_grade": 64},
}
