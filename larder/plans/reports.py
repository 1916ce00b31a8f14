"""Seven questions to the star.

Reports that aggregate first reduce the fact to one row per product, then the products to one row
per brand or category, and only then join the next dimension. Every join sees each key once on
both sides, so a brand or category with a third of all rows adds no work to any single task.

Sums are taken in decimal: the order in which partial sums meet then has no effect on the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.tags import json_list_items
from larder.functions.text import is_filled

# Grades, noise per report, label of the unknown.
GRADES = ("a", "b", "c", "d", "e")
GOOD_GRADES = ("a", "b")
NOISE_BRANDS = ("0", "unknown", "sans marque", "n/a", "-", "_")
NOISE_CATEGORIES = ("0", "unknown", "n/a", "-", "_")
UNKNOWN = "inconnu"

_COUNT = "n"
_SUM = "__sum"


def _sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(28,10)"))


def _mean(digits: int) -> Column:
    return F.round(F.col(_SUM).cast("double") / F.col(_COUNT), digits)


def _per_product(fact: DataFrame, measure: str) -> DataFrame:
    rows = fact.where(F.col(measure).isNotNull())
    return rows.groupBy("product_sk").agg(
        _sum(F.col(measure)).alias(_SUM), F.count(F.lit(1)).alias(_COUNT)
    )


def _roll_up(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(_SUM).alias(_SUM), F.sum(_COUNT).alias(_COUNT))


def _category(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN)).alias("category")


def top_brands_by_grade(
    fact: DataFrame, product: DataFrame, brand: DataFrame, k: int = 10, min_rows: int = 20
) -> DataFrame:
    """Brands with the largest share of grades a and b."""
    graded = fact.where(F.col("nutriscore_grade").isin(*GRADES))
    per_product = graded.groupBy("product_sk").agg(
        F.count_if(F.col("nutriscore_grade").isin(*GOOD_GRADES)).alias("n_ab"),
        F.count(F.lit(1)).alias("n_total"),
    )
    per_brand = (
        per_product.join(product.select("product_sk", "brand_sk"), "product_sk")
        .groupBy("brand_sk")
        .agg(F.sum("n_ab").alias("n_ab"), F.sum("n_total").alias("n_total"))
        .where(F.col("n_total") >= min_rows)
    )
    share = F.round(F.try_divide(F.col("n_ab"), F.col("n_total")) * 100, 2)
    return (
        per_brand.join(brand.select("brand_sk", "brand_name"), "brand_sk")
        .where(~F.col("brand_name").isin(*NOISE_BRANDS))
        .select("brand_name", "n_ab", "n_total", share.alias("pct_ab"))
        .orderBy(F.desc("pct_ab"), F.desc("n_total"), F.asc("brand_name"))
        .limit(k)
    )


def grade_by_category(fact: DataFrame, product: DataFrame, category: DataFrame) -> DataFrame:
    """Number of fact rows per primary category and grade."""
    graded = fact.where(F.col("nutriscore_grade").isin(*GRADES))
    # A column per grade: the fact is grouped by the key that it is joined on next.
    per_product = graded.groupBy("product_sk").agg(
        *[F.count_if(F.col("nutriscore_grade") == grade).alias(grade) for grade in GRADES]
    )
    per_category = (
        per_product.join(product.select("product_sk", "primary_category_sk"), "product_sk")
        .groupBy("primary_category_sk")
        .agg(*[F.sum(grade).alias(grade) for grade in GRADES])
        .unpivot("primary_category_sk", list(GRADES), "nutriscore_grade", _COUNT)
        .where(F.col(_COUNT) > 0)
    )
    known = category.where(~F.col("category_code").isin(*NOISE_CATEGORIES)).select(
        F.col("category_sk").alias("primary_category_sk"), F.col("category_code").alias("category")
    )
    return (
        per_category.join(known, "primary_category_sk")
        .select("category", "nutriscore_grade", _COUNT)
        .orderBy("category", "nutriscore_grade")
    )


def sugar_by_category_and_country(
    fact: DataFrame, product: DataFrame, category: DataFrame, min_rows: int = 10
) -> DataFrame:
    """Mean sugars per primary category and country of sale."""
    countries = product.select(
        "product_sk", "primary_category_sk", F.explode(json_list_items(F.col("countries_multi"))).alias("country_code")
    ).where(is_filled(F.col("country_code")))
    cells = _roll_up(
        _per_product(fact, "sugars_100g").join(countries, "product_sk"), "primary_category_sk", "country_code"
    )
    known = category.select(F.col("category_sk").alias("primary_category_sk"), "category_code")
    return (
        cells.where(F.col(_COUNT) >= min_rows)
        .join(known, "primary_category_sk", "left")
        .where(~F.coalesce("category_code", F.lit("")).isin(*NOISE_CATEGORIES))
        .select(_category(F.col("category_code")), "country_code", _mean(2).alias("avg_sugars_100g"), _COUNT)
        .orderBy("category", F.desc("avg_sugars_100g"), "country_code")
    )


def completeness_by_brand(
    fact: DataFrame, product: DataFrame, brand: DataFrame, min_rows: int = 20
) -> DataFrame:
    """Mean completeness per brand."""
    per_product = _per_product(fact, "completeness_score")
    per_brand = _roll_up(
        per_product.join(product.select("product_sk", "brand_sk"), "product_sk"), "brand_sk"
    ).where(F.col(_COUNT) >= min_rows)
    return (
        per_brand.join(brand.select("brand_sk", "brand_name"), "brand_sk")
        .where(~F.col("brand_name").isin(*NOISE_BRANDS))
        .select("brand_name", _mean(3).alias("avg_completeness"), _COUNT)
        .orderBy(F.desc("avg_completeness"), F.desc(_COUNT), F.asc("brand_name"))
    )


def anomalies(
    fact: DataFrame,
    product: DataFrame,
    category: DataFrame,
    salt_limit: float = 25,
    sugars_limit: float = 80,
) -> DataFrame:
    """Fact rows with very much salt or sugar.

    Code and date end the ordering, so equal measures still spread over the sort's ranges.
    """
    extreme = fact.where((F.col("salt_100g") > salt_limit) | (F.col("sugars_100g") > sugars_limit))
    known = category.select(F.col("category_sk").alias("primary_category_sk"), "category_code")
    return (
        extreme.select("product_sk", "time_sk", "salt_100g", "sugars_100g")
        .join(
            product.where(is_filled(F.col("code"))).select(
                "product_sk", "code", "product_name", "primary_category_sk"
            ),
            "product_sk",
        )
        .join(known, "primary_category_sk", "left")
        .orderBy(
            F.col("salt_100g").desc_nulls_last(), F.col("sugars_100g").desc_nulls_last(), "code", "time_sk"
        )
        .select(
            "code",
            F.coalesce("product_name", F.lit(UNKNOWN)).alias("product_name"),
            _category(F.col("category_code")),
            "salt_100g",
            "sugars_100g",
        )
    )


def weekly_completeness(
    fact: DataFrame, time: DataFrame, year: str = "year", min_rows: int = 20
) -> DataFrame:
    """Mean completeness per week.

    ``year="iso_year"`` keeps a week that spans New Year together with its own ISO year; the
    default pairs the ISO week with the calendar year.
    """
    rows = fact.where(F.col("completeness_score").isNotNull())
    per_day = rows.groupBy("time_sk").agg(
        _sum(F.col("completeness_score")).alias(_SUM), F.count(F.lit(1)).alias(_COUNT)
    )
    weeks = _roll_up(per_day.join(time.select("time_sk", year, "iso_week"), "time_sk"), year, "iso_week")
    return (
        weeks.where(F.col(_COUNT) >= min_rows)
        .select(year, "iso_week", _mean(3).alias("avg_completeness"), _COUNT)
        .orderBy(year, "iso_week")
    )


def least_complete_categories(
    fact: DataFrame, product: DataFrame, category: DataFrame, k: int = 20, min_rows: int = 1000
) -> DataFrame:
    """Large categories with the lowest mean completeness."""
    per_product = _per_product(fact, "completeness_score")
    per_category = _roll_up(
        per_product.join(product.select("product_sk", "primary_category_sk"), "product_sk"),
        "primary_category_sk",
    )
    known = category.select(F.col("category_sk").alias("primary_category_sk"), "category_code")
    return (
        per_category.where(F.col(_COUNT) >= min_rows)
        .join(known, "primary_category_sk", "left")
        .select(_category(F.col("category_code")), _mean(3).alias("avg_completeness"), _COUNT)
        .orderBy(F.asc("avg_completeness"), F.desc(_COUNT), F.asc("category"))
        .limit(k)
    )
