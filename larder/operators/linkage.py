"""Linking records whose names differ by typing errors, and merging what was linked.

Names are compared within a block only, and never all with all. Two names within ``k`` edits of each
other share at least one text that remains after deleting up to ``k`` characters from each. Names
therefore meet in a join on such remainders. Copies of a name are reduced to one before that, and
only so many different names can shrink to the same remainder (fewer than (length + 1) x alphabet for
one edit), so no join group grows with the data, whatever the size of a block. No candidate is left out.

A name of length L has about L**k / k! remainders: made for titles and names, with k of 1 or 2. Each is a row of its own
with two hashes and the block. A task holds the L texts of one deletion step of one name at a time (L**2 characters), with
two edits as with one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import canonical, edit_distance, is_filled


def _shorter_by_one(text: Column, begin: Column) -> Column:
    """(position, what is left) for each deletion at ``begin`` or behind; of equal neighbours only the first is deleted."""
    positions = F.when(F.length(text) >= begin, F.sequence(begin, F.length(text)))
    heads = F.filter(
        positions, lambda i: (i == 1) | (F.substring(text, i, F.lit(1)) != F.substring(text, i - 1, F.lit(1)))
    )
    return F.transform(
        heads,
        lambda i: F.struct(
            i.alias("begin"),
            F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))).alias("rest"),
        ),
    )


def remainders(names: DataFrame, name: str, edits: int) -> DataFrame:
    """``names`` with a column ``rest``: the name itself and everything left of it after deleting up to ``edits``
    characters.

    A deletion is never followed by one before it. Deleting a later one of equal neighbours, or two characters in another
    order, leaves nothing else. The same text may come more than once when its letters alternate.
    """
    reached = frontier = names.select("*", F.lit(1).alias("begin"), F.col(name).alias("rest"))
    for _ in range(edits):
        frontier = frontier.select(*names.columns, F.explode(_shorter_by_one(F.col("rest"), F.col("begin"))).alias("step"))
        frontier = frontier.select(*names.columns, "step.begin", "step.rest")
        reached = reached.unionByName(frontier)
    return reached.drop("begin")


def distinct_names(df: DataFrame, block: str, name: str) -> DataFrame:
    """Canonical names that occur in each block, each once.

    Spellings and names are counted, and what is tied to a count stays above it. Without that tie, the filter on the canonical form would be
    pushed below the aggregates and compute it for every row there, more than once.
    """
    for column in (F.col(name), canonical(F.col("name"))):
        counted = df.select(F.col(block).alias("block"), column.alias("name")).groupBy("block", "name").agg(F.count(F.lit(1)).alias("uses"))
        df, block = counted.select("block", F.when(F.col("uses") > 0, F.col("name")).alias("name")), "block"
    return df.where(F.col("block").isNotNull() & is_filled(F.col("name")))


def _with_remainders(names: DataFrame, alias: str, edits: int) -> DataFrame:
    """Hashes of names and remainders, so that no row carries a text."""
    numbered = names.select("block", "name", F.xxhash64("name").alias(alias))
    return remainders(numbered, "name", edits).select("block", alias, F.xxhash64("rest").alias("__rest"))


def _named(names: DataFrame, number: str, name: str) -> DataFrame:
    return names.select("block", F.xxhash64("name").alias(number), F.col("name").alias(name))


def similar_names(left: DataFrame, right: DataFrame, edits: int) -> DataFrame:
    """Pairs of distinct names of the same block at most ``edits`` apart, equal names included.

    Names that meet are looked up again by their hash; every pair is then compared as text.
    """
    met = _with_remainders(left, "__left", edits).join(
        _with_remainders(right, "__right", edits), ["block", "__rest"]
    )
    pairs = (
        met.select("block", "__left", "__right")
        .distinct()
        .join(_named(left, "__left", "left_name"), ["block", "__left"])
        .join(_named(right, "__right", "right_name"), ["block", "__right"])
    )
    distance = edit_distance(F.col("left_name"), F.col("right_name"), edits)
    return pairs.select("block", "left_name", "right_name", distance.alias("distance")).where(
        F.col("distance").isNotNull()
    )


def fuzzy_pairs(df: DataFrame, block: str, name: str, edits: int) -> DataFrame:
    """Different names within one source that are at most ``edits`` apart, each pair once."""
    names = distinct_names(df, block, name)
    return similar_names(names, names, edits).where(F.col("left_name") < F.col("right_name"))


def link_to_master(
    master: DataFrame, incoming: DataFrame, block: str, name: str, edits: int
) -> DataFrame:
    """Best master name for each incoming name: nearest first, then alphabetical.

    Incoming names without a match are kept, with NULL for the master name and the distance.
    """
    wanted = distinct_names(incoming, block, name)
    pairs = similar_names(distinct_names(master, block, name), wanted, edits)
    best = pairs.groupBy("block", F.col("right_name").alias("name")).agg(
        F.min(F.struct("distance", "left_name")).alias("best")
    )
    return wanted.join(best, ["block", "name"], "left").select(
        "block", "name", F.col("best.left_name").alias("master_name"), F.col("best.distance").alias("distance")
    )


def first_filled(attribute: str, rank: Sequence[str]) -> Column:
    """Aggregate: the first filled value by ``rank``, as a struct that can be compared and merged further; it ends with ``value``."""
    value = F.struct(*[F.col(r) for r in rank], F.col(attribute).alias("value"))
    return F.min(F.when(F.col(attribute).isNotNull(), value))


def golden_records(
    master: DataFrame,
    incoming: DataFrame,
    block: str,
    name: str,
    record_id: str,
    attributes: Sequence[str],
    edits: int,
) -> DataFrame:
    """Merge the records of a master source and an incoming source.

    Records with the same canonical name in a block are one entity, and an incoming name joins the
    entity of its best master name. Each attribute takes its first filled value: master before
    incoming, then the smallest record id. Records without a block or a name cannot be linked and
    stay entities of their own.

    Records are merged per name before names are linked, so the links are joined to unique names.
    """
    labelled = [
        df.select(
            F.col(block).alias("block"),
            canonical(F.col(name)).alias("name"),
            F.lit(priority).alias("priority"),
            F.col(record_id).cast("string").alias("record_id"),
            *attributes,
        )
        for priority, df in enumerate((master, incoming))
    ]
    records = labelled[0].unionByName(labelled[1])
    linkable = F.col("block").isNotNull() & is_filled(F.col("name"))
    records = records.withColumn(
        "__own", F.when(~linkable, F.concat_ws(":", F.col("priority").cast("string"), F.col("record_id")))
    )
    rank = ("priority", "record_id")
    per_name = records.groupBy("block", "name", "priority", "__own").agg(
        F.count(F.lit(1)).alias("n_records"), *[first_filled(a, rank).alias(a) for a in attributes]
    )
    links = link_to_master(master, incoming, block, name, edits).where(
        F.col("master_name").isNotNull()
    ).select("block", "name", F.lit(1).alias("priority"), "master_name")
    entities = per_name.join(links, ["block", "name", "priority"], "left").withColumn(
        "name", F.coalesce("master_name", "name")
    )
    merged = entities.groupBy("block", "name", "__own").agg(
        F.sum("n_records").alias("n_records"),
        F.count_distinct("priority").alias("n_sources"),
        *[F.min(a).alias(a) for a in attributes],
    )
    return merged.select(
        "block", "name", "n_records", "n_sources", *[F.col(f"{a}.value").alias(a) for a in attributes]
    )
