"""Bronze rows to the clean product table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import keys as K
from larder.functions import nutrients as N
from larder.functions import quality as Q
from larder.functions import tags as G
from larder.functions import text as X
from larder.operators.columns import conform, keep_known
from larder.operators.dedup import any_per_key, keep_latest
from larder.schemas import BRONZE_COLUMNS, NUTRIENT_COLUMNS, SILVER

# Text columns that are normalised in place.
NORMALISED = ("brands", "categories", "countries", "nutriscore_grade", "ecoscore_grade", "lang")


def _column(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def with_event_time(bronze: DataFrame) -> DataFrame:
    stamped = bronze.withColumn("last_modified_ts", K.epoch_timestamp(_column(bronze, "last_modified_t")))
    return stamped.withColumn("event_date", K.event_date(F.col("last_modified_ts")))


def latest_versions(
    bronze: DataFrame, keys: Sequence[str] = ("code",), tie_breakers: Sequence[str] = (), sources_first: bool = False
) -> DataFrame:
    """Newest row per key; any row per key if there is no change time; all rows if there is no key."""
    stamped = with_event_time(bronze)
    hashed = stamped.columns
    if sources_first:
        stamped = with_sources(stamped)
    if not set(keys) <= set(stamped.columns):
        return stamped
    if "last_modified_t" not in bronze.columns and not tie_breakers:
        return any_per_key(stamped, keys)
    return keep_latest(stamped, keys, F.col("last_modified_ts"), tie_breakers, hashed)


def with_sources(df: DataFrame) -> DataFrame:
    """Of columns that stand for each other the one that counts, as it is."""
    name = X.preferred_name(
        _column(df, "product_name_fr"), _column(df, "product_name"), _column(df, "product_name_en")
    )
    named = df.withColumns(
        {
            "product_name_pref": name,
            "__categories": G.tag_source(_column(df, "categories_tags"), _column(df, "categories")),
            "__countries": G.tag_source(_column(df, "countries_tags"), _column(df, "countries")),
        }
    )
    return named.withColumn("has_name", Q.presence_flag(F.col("product_name_pref")))


def with_names(df: DataFrame) -> DataFrame:
    df = df.withColumns({name: X.normalise(F.col(name)) for name in NORMALISED if name in df.columns})
    if "product_name_pref" in df.columns:
        return df
    name = X.preferred_name(
        _column(df, "product_name_fr"), _column(df, "product_name"), _column(df, "product_name_en")
    )
    return df.withColumn("product_name_pref", name)


def with_tags(df: DataFrame) -> DataFrame:
    """Brand, category and country lists with their first element, from normalised brands."""
    if "__categories" not in df.columns:
        df = df.withColumns(
            {
                "__categories": G.tag_source(_column(df, "categories_tags"), _column(df, "categories")),
                "__countries": G.tag_source(_column(df, "countries_tags"), _column(df, "countries")),
            }
        )
    categories, countries = X.normalise(F.col("__categories")), X.normalise(F.col("__countries"))
    df = df.withColumns(
        {
            "brands_arr": G.tag_items(_column(df, "brands")),
            "categories_arr": G.clean_tags(categories),
            "countries_arr": G.clean_tags(countries),
        }
    ).drop("__categories", "__countries")
    df = df.withColumns(
        {
            "brands_clean_arr": G.meaningful_items(F.col("brands_arr")),
            "categories_codes": G.tag_codes(F.col("categories_arr")),
            "countries_codes": G.tag_codes(F.col("countries_arr")),
        }
    )
    return df.withColumns(
        {
            "brand_primary": G.first_item(F.col("brands_clean_arr")),
            "primary_category_code": G.first_item(F.col("categories_codes")),
            "country_primary_code": G.first_item(F.col("countries_codes")),
        }
    )


def with_nutrients(
    df: DataFrame,
    salt_mode: str = "column",
    bounds: dict[str, tuple[float, float]] = N.NUTRIENT_BOUNDS,
) -> DataFrame:
    """Parsed, harmonised and clamped measures.

    ``salt_parsed`` and ``sugars_parsed`` keep the values before clamping for the issue list.
    """
    parsed = {c: N.parse_number(F.col(f"`{c}`")) for c in NUTRIENT_COLUMNS if c in df.columns}
    df = df.withColumns(N.harmonise_salt(parsed, salt_mode))
    present = [c for c in NUTRIENT_COLUMNS if c in df.columns]
    nothing = F.lit(None).cast("double")
    clamped = {c: N.clamp(F.col(f"`{c}`"), *bounds[c]) for c in present if c in bounds}
    return df.withColumns(
        {
            "salt_parsed": F.col("salt_100g") if "salt_100g" in present else nothing,
            "sugars_parsed": F.col("sugars_100g") if "sugars_100g" in present else nothing,
            **clamped,
        }
    )


def with_quality(df: DataFrame) -> DataFrame:
    core = [c for c in N.CORE_NUTRIENTS if c in df.columns]
    named = F.col("has_name") if "has_name" in df.columns else Q.presence_flag(F.col("product_name_pref"))
    df = df.withColumns(
        {
            "has_name": named,
            "has_brands": Q.presence_flag(F.col("brand_primary")),
            "core_nutrients_count": Q.count_present([F.col(f"`{c}`") for c in core]),
        }
    )
    issues = Q.quality_issues_json(
        F.col("salt_parsed"), F.col("sugars_parsed"), F.col("brand_primary"), F.col("primary_category_code")
    )
    score = Q.completeness(
        [F.col("has_name"), F.col("has_brands")], F.col("core_nutrients_count"), len(core)
    )
    return df.withColumns({"completeness_score": score, "quality_issues_json": issues})


def silver_products(
    bronze: DataFrame,
    keys: Sequence[str] = ("code",),
    tie_breakers: Sequence[str] = (),
    salt_mode: str = "column",
    bounds: dict[str, tuple[float, float]] = N.NUTRIENT_BOUNDS,
    sources_first: bool = False,
) -> DataFrame:
    """Clean product table with the declared layout.

    The newest rows are chosen on raw columns, so everything costly runs on the survivors only and
    in the stage that follows the one exchange. ``keys`` may be ``("code", "event_date")`` to keep
    one row per product and day. With ``sources_first`` names, categories and countries that stand for each other are settled
    before the exchange, which then is narrower for plans that read few of the columns, and wider for those that read all.
    """
    known = keep_known(bronze, (*BRONZE_COLUMNS, *tie_breakers))
    latest = latest_versions(known, keys, tie_breakers, sources_first).drop(*tie_breakers)
    cleaned = with_nutrients(with_tags(with_names(latest)), salt_mode, bounds)
    return conform(with_quality(cleaned), SILVER)


def run_metrics(silver: DataFrame) -> DataFrame:
    """Row counts and mean score of a silver table, as one row."""
    return silver.agg(*metric_columns())


def metric_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows_total"),
        F.count("code").alias("rows_with_code"),
        F.count("sugars_100g").alias("rows_with_sugars_100g"),
        F.avg("completeness_score").alias("avg_completeness_score"),
    ]
