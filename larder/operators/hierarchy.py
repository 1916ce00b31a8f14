"""Hierarchy of categories from the order of the lists on products.

A list goes from the general to the special: what stands before a category is a vote for its parent, and the first place is a vote
for having none. Votes are counted by partial aggregates, so what follows works on one row per category, however
many products there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.workspace import Workspace

MOST_ROUNDS = 64


def parent_votes(lists: Column) -> Column:
    """(code, parent) for each place of a list that names each code once; the first place has NULL for its parent."""
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(lists, F.lit(1), F.greatest(F.size(lists) - 1, F.lit(0))))
    return F.when(F.size(lists) > 0, F.arrays_zip(lists.alias("code"), before.alias("parent")))


def category_parents(products: DataFrame, lists: str, work: Workspace) -> DataFrame:
    """``code`` and ``parent`` of every category in the list column ``lists``; the parent is NULL at the top.

    The parent is what most lists have before the category; no parent wins a tie, then the smaller code. Where parents go
    round in a circle, the smallest code of the circle goes to the top.
    """
    found = products.select(F.inline(parent_votes(F.col(lists)))).where(F.col("code").isNotNull())
    votes = found.groupBy("code", "parent").agg(F.count(F.lit(1)).alias("n"))
    # NULL comes first among equals.
    first = votes.groupBy("code").agg(F.min(F.struct((-F.col("n")).alias("rank"), "parent")).alias("first"))
    parents = work.store(first.select("code", F.col("first.parent").alias("parent")), "parents")
    circles = _circle_heads(parents, work)
    if circles is None:
        return parents
    cut = parents.join(circles.withColumn("cut", F.lit(True)), "code", "left")
    return cut.select("code", F.when(F.col("cut").isNull(), F.col("parent")).alias("parent"))


def _circle_heads(parents: DataFrame, work: Workspace) -> DataFrame | None:
    """Smallest code of each circle of parents, or None without one.

    Each round doubles the steps taken from a category and keeps the smallest code on the way. Categories that reach the top leave, so
    without circles little is left after a few rounds. What is still on its way after as many steps as there are categories goes
    round for ever, and the places it has come to are those on circles.
    """
    left = parents.where(F.col("parent").isNotNull())
    left = work.store(left.select("code", F.col("parent").alias("at"), F.least("code", "parent").alias("least")), "steps")
    steps, count = 1, left.count()
    total = count
    for _ in range(MOST_ROUNDS):
        if not count:
            return None
        if steps > total:
            here = left.select(F.col("at").alias("code")).distinct()
            return here.join(left, "code").where(F.col("least") == F.col("code")).select("code")
        on = left.select(F.col("code").alias("at"), F.col("at").alias("next"), F.col("least").alias("further"))
        moved = left.join(on, "at").select("code", F.col("next").alias("at"), F.least("least", "further").alias("least"))
        before, left = left, work.store(moved, "steps")
        work.remove(before)
        steps, count = 2 * steps, left.count()
    raise RuntimeError("categories do not settle")


def category_ancestors(parents: DataFrame) -> DataFrame:
    """``code``, ``ancestor`` and ``distance`` for each category and all above it, itself (0) included.

    ``parents`` has no circles. The recursive query takes a step per level of the hierarchy; Spark's own limits on levels
    (``spark.sql.cteRecursionLevelLimit``) and rows (``spark.sql.cteRecursionRowLimit``) end it with an error, never with less.
    """
    spark: SparkSession = parents.sparkSession
    return spark.sql(
        """WITH RECURSIVE above(code, ancestor, distance) AS (
             SELECT code, code, 0 FROM {parents}
             UNION ALL
             SELECT a.code, p.parent, a.distance + 1
             FROM above a JOIN {parents} p ON p.code = a.ancestor
             WHERE p.parent IS NOT NULL
           )
           SELECT code, ancestor, distance FROM above""",
        parents=parents.where(F.col("code").isNotNull()),
    )


def category_levels(parents: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``code``, ``parent`` and ``level``: 1 at the top."""
    depth = ancestors.groupBy("code").agg((F.max("distance") + 1).cast("int").alias("level"))
    return parents.join(depth, "code").select("code", "parent", "level")


def rolled_up(report: DataFrame, category: str, ancestors: DataFrame, sums: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """A report by category (and ``others``) with the sums of each category and all below it. A row whose category is unknown to
    ``ancestors`` counts for its own category alone.

    ``report`` is reduced to one row per key first, so a category with many rows does not meet its ancestors row by row.
    """
    keys = [category, *others]
    one = report.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    above = ancestors.select(F.col("code").alias(category), "ancestor")
    joined = one.join(above, category, "left").withColumn(category, F.coalesce("ancestor", category)).drop("ancestor")
    return joined.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
