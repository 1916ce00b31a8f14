"""Delimited tag text to clean lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import NOISE_ITEM


def tag_items(text: Column) -> Column:
    """Items between commas or semicolons of normalised text; empty items are still there.

    Normalised text has at most one blank on either side of a separator. With those gone, the items
    need no work of their own.
    """
    commas = F.replace(text, F.lit(";"), F.lit(","))
    tight = F.replace(F.replace(commas, F.lit(", "), F.lit(",")), F.lit(" ,"), F.lit(","))
    return F.split(tight, ",")


def is_meaningful(item: Column) -> Column:
    return (F.length(item) > 1) & ~item.rlike(NOISE_ITEM)


def meaningful_items(items: Column) -> Column:
    return F.filter(items, is_meaningful)


def clean_tags(text: Column) -> Column:
    return meaningful_items(tag_items(text))


def tag_source(tags: Column, text: Column) -> Column:
    """The tag column wins whenever it is not NULL, even if empty."""
    return F.coalesce(tags, text)


def _code_of(item: Column) -> Column:
    return F.when(F.contains(item, F.lit(":")), F.split_part(item, F.lit(":"), F.lit(2))).otherwise(item)


def tag_codes(items: Column) -> Column:
    """``lang:code`` becomes ``code``; results that are noise after that are dropped."""
    return meaningful_items(F.transform(items, _code_of))


def first_item(items: Column) -> Column:
    """First element, NULL for an empty or missing list."""
    return F.get(items, F.lit(0))


def items_as_text(items: Column) -> Column:
    return F.array_join(items, "|")


def json_list_items(c: Column) -> Column:
    """Elements of a JSON list; anything that is not a list gives NULL."""
    return F.from_json(c, "array<string>")
