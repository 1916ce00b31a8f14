"""Presence flags, completeness score and issue lists."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and issue names.
SALT_LIMIT = 25
SUGARS_LIMIT = 80
SALT_ISSUE = "salt_gt_25"
SUGARS_ISSUE = "sugars_gt_80"
BRAND_ISSUE = "brand_missing"
CATEGORY_ISSUE = "cat_missing"


def presence_flag(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False)).cast("int")


def count_present(columns: list[Column]) -> Column:
    return reduce(add, [c.isNotNull().cast("int") for c in columns], F.lit(0))


def completeness(flags: list[Column], nutrient_count: Column, nutrients: int) -> Column:
    """Share of filled essentials: the flags plus the nutrients that the input has columns for."""
    return reduce(add, flags, nutrient_count).cast("double") / F.lit(float(len(flags) + nutrients))


def _issues(salt: Column, sugars: Column, brand: Column, category: Column) -> dict[str, Column]:
    return {
        SALT_ISSUE: salt > SALT_LIMIT,
        SUGARS_ISSUE: sugars > SUGARS_LIMIT,
        BRAND_ISSUE: presence_flag(brand) == 0,
        CATEGORY_ISSUE: presence_flag(category) == 0,
    }


def quality_issues(salt: Column, sugars: Column, brand: Column, category: Column) -> Column:
    """Issue names as an array; judge salt and sugars before clamping, or the limits never show."""
    found = _issues(salt, sugars, brand, category)
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in found.items()]))


def quality_issues_json(salt: Column, sugars: Column, brand: Column, category: Column) -> Column:
    """The same names as a JSON list. They need no escapes, so plain joining writes it."""
    found = _issues(salt, sugars, brand, category)
    names = F.concat_ws(",", *[F.when(holds, F.lit(f'"{name}"')) for name, holds in found.items()])
    return F.concat(F.lit("["), names, F.lit("]"))
