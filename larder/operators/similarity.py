"""Similarity join of names on their q-grams, within a block.

Grams of a name are ordered by how many names have them, seldom ones first. Two names that are similar enough share a
gram among the first few of both (the prefix), so only prefixes are joined. How long a prefix has to be follows from the
threshold; pairs that differ too much in length, or whose grams after the shared one cannot suffice any more, are left out in
the join, and the others are compared as text. No pair that meets the threshold is lost, and none is made just because two names stand in
the same block.

With a high threshold names share several of their first grams if the prefix is longer by as many less one. There, names meet on three grams
at once: names that are alike but for a number share single grams very often, and three of them hardly ever.

A gram that very many prefixes have is dealt to several tasks: names of the left side are spread over its slices, names of the
right side visit all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import edit_distance
from larder.operators.linkage import distinct_names, similar_names
from larder.sources.workspace import Workspace

# Canonical names hold letters, digits and blanks only.
BEGIN, END = "#", "$"
SLICE = 10_000  # left names with a gram in their prefix that meet others in one task
TOGETHER = 3  # grams on which names meet at once with a threshold from here on
HIGH_THRESHOLD = 0.85
MOST_GRAMS = 32  # of a name that meets others that way: of n grams there are n * (n - 1) * (n - 2) / 6 threes
NAMES_PER_TASK = 20_000
BROADCAST_ROWS = 100_000  # rows that a broadcast of gram counts may have; more are joined by a shuffle


def grams(name: Column, q: int) -> Column:
    """Distinct runs of ``q`` characters, with marks for begin and end: no name is without one."""
    marked = F.concat(F.lit(BEGIN * (q - 1)), name, F.lit(END * (q - 1)))
    places = F.sequence(F.lit(1), F.greatest(F.length(marked) - (q - 1), F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(marked, i, F.lit(q))))


def jaccard(left: Column, right: Column) -> Column:
    return F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))


def _limited(df: DataFrame) -> DataFrame:
    """To be broadcast if it was counted and found small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _gram_rows(names: DataFrame, q: int) -> DataFrame:
    rows = names.select("block", "name", F.length("name").alias("length"), grams(F.col("name"), q).alias("all"))
    return rows.select("block", "name", "length", F.size("all").alias("size"), F.explode("all").alias("gram"))


def _first_grams(rows: DataFrame, uses: DataFrame, kept: Column) -> DataFrame:
    """First ``kept`` grams of each name, seldom ones first, as a list."""
    counted = rows.join(uses, "gram").groupBy("block", "name", "length", "size")
    ordered = counted.agg(F.sort_array(F.collect_list(F.struct("uses", "gram"))).alias("all"))
    first = F.slice("all", F.lit(1), kept.cast("int")).getField("gram")
    return ordered.select("block", F.xxhash64("name").alias("id"), "length", "size", first.alias("first"))


def _prefixes(rows: DataFrame, uses: DataFrame, kept: Column) -> DataFrame:
    """First ``kept`` grams of each name, a row for each; ``place`` counts from 0."""
    return _first_grams(rows, uses, kept).select("block", "id", "length", "size", F.posexplode("first").alias("place", "gram"))


def _combined(rows: DataFrame, uses: DataFrame, kept: Column) -> DataFrame:
    """As ``_prefixes``, with the hash of ``TOGETHER`` grams in place of each gram, for all choices of so many of the first ``kept``."""
    names = ["block", "id", "length", "size"]
    chosen = _first_grams(rows, uses, kept).select(*names, F.lit(0).cast("long").alias("gram"), F.col("first").alias("rest"))
    for _ in range(TOGETHER):
        taken = chosen.select(*names, "gram", "rest", F.posexplode("rest").alias("place", "one"))
        after = F.slice("rest", F.col("place") + 2, F.size("rest"))
        chosen = taken.select(*names, F.xxhash64("gram", "one").alias("gram"), after.alias("rest"))
    return chosen.select(*names, F.lit(0).alias("place"), "gram")


def _met(left: DataFrame, right: DataFrame, enough: Column, most: int) -> DataFrame:
    """Pairs of ids that share a gram of their prefixes and hold ``enough``."""
    counts = left.groupBy("block", "gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    parts = counts.select("block", "gram", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    parts = _limited(parts)
    one = F.coalesce("parts", F.lit(1))
    dealt = left.join(parts, ["block", "gram"], "left").withColumn("slice", F.pmod("id", one).cast("int")).drop("parts")
    copied = right.join(parts, ["block", "gram"], "left")
    copied = copied.withColumn("slice", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    a = dealt.select("block", "gram", "slice", *[F.col(c).alias(f"l_{c}") for c in ("id", "length", "size", "place")])
    b = copied.select("block", "gram", "slice", *[F.col(c).alias(f"r_{c}") for c in ("id", "length", "size", "place")])
    return a.join(b, ["block", "gram", "slice"]).where(enough).select("block", "l_id", "r_id").distinct()


def _named(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    a = left.select("block", F.xxhash64("name").alias("l_id"), F.col("name").alias("left_name"))
    b = right.select("block", F.xxhash64("name").alias("r_id"), F.col("name").alias("right_name"))
    return pairs.join(a, ["block", "l_id"]).join(b, ["block", "r_id"]).select("block", "left_name", "right_name")


def _gram_uses(left: DataFrame, right: DataFrame) -> DataFrame:
    rows = left.select("gram").unionByName(right.select("gram"))
    return _limited(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("uses")))


def _reachable() -> Column:
    """Most grams that a pair can share: the one at hand, those before it in both, and those behind it in both."""
    left_rest, right_rest = F.col("l_size") - F.col("l_place"), F.col("r_size") - F.col("r_place")
    return F.least("l_place", "r_place") + F.least(left_rest, right_rest)


def alike_by_grams(left: DataFrame, right: DataFrame, threshold: float, q: int = 2, most: int = SLICE) -> DataFrame:
    """Pairs of names (``block``, ``name``, each once on either side) whose grams have a Jaccard similarity of ``threshold`` or more, as
    ``left_name``, ``right_name`` and ``similarity``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    # Rounding must not cost a pair that meets the threshold exactly.
    slack = 1e-9
    a, b = _gram_rows(left, q), _gram_rows(right, q)
    uses = _gram_uses(a, b)
    shared = F.ceil(threshold * F.col("size") - slack)  # grams that a name shares with any that is similar enough, at least
    kept = F.col("size") - shared + 1
    needed = F.ceil(threshold / (1 + threshold) * (F.col("l_size") + F.col("r_size")) - slack)
    sizes = F.least("l_size", "r_size") >= threshold * F.greatest("l_size", "r_size") - slack
    if threshold < HIGH_THRESHOLD:
        met = _met(_prefixes(a, uses, kept), _prefixes(b, uses, kept), sizes & (_reachable() >= needed), most)
    else:
        # Three grams at once, unless a name has very many of them or both have so few that they need not share three.
        usual = F.col("size") <= MOST_GRAMS
        threes = [_combined(x.where(usual), uses, kept + (TOGETHER - 1)) for x in (a, b)]
        few = shared < TOGETHER
        other = few | (F.col("size") >= threshold * MOST_GRAMS - 1)
        single = [_prefixes(x.where(other), uses, kept) for x in (a, b)]
        least = F.ceil(threshold * F.greatest("l_size", "r_size") - slack)
        left_over = (F.greatest("l_size", "r_size") > MOST_GRAMS) | (least < TOGETHER)
        met = _met(*threes, sizes, most).unionByName(_met(*single, sizes & left_over & (_reachable() >= needed), most))
    pairs = _named(met, left, right)
    score = jaccard(grams(F.col("left_name"), q), grams(F.col("right_name"), q))
    return pairs.withColumn("similarity", score).where(F.col("similarity") >= threshold)


def alike_by_edits(left: DataFrame, right: DataFrame, edits: int, q: int = 2, most: int = SLICE) -> DataFrame:
    """Pairs of names at most ``edits`` apart, as ``left_name``, ``right_name`` and ``distance``.

    An edit touches at most ``q`` grams, so names that are ``edits`` apart miss at most ``edits`` * ``q`` grams of each other. Pairs in
    which neither name has more grams than that need not share one; they are found over deletions (``similar_names``): such names
    are short, or repeat a few grams, and have few remainders.
    """
    lost = edits * q
    a, b = _gram_rows(left, q), _gram_rows(right, q)
    uses = _gram_uses(a, b)
    kept = F.least(F.col("size"), F.lit(lost + 1))
    larger = F.greatest("l_size", "r_size")
    enough = (F.abs(F.col("l_length") - F.col("r_length")) <= edits) & (larger > lost) & (_reachable() >= larger - lost)
    pairs = _named(_met(_prefixes(a, uses, kept), _prefixes(b, uses, kept), enough, most), left, right)
    found = pairs.withColumn("distance", edit_distance(F.col("left_name"), F.col("right_name"), edits))
    few = lambda names: names.where(F.size(grams(F.col("name"), q)) <= lost)
    rest = similar_names(few(left), few(right), edits)
    return found.where(F.col("distance").isNotNull()).unionByName(rest)


def _spread(names: DataFrame, work: Workspace | None) -> DataFrame:
    """Names as stored in ``work``, in as many parts as their number asks for: a few megabytes of names are much work."""
    if work is None:
        return names
    stored = work.store(names, "names")
    parts = -(-stored.count() // NAMES_PER_TASK)
    return stored.repartition(parts, "block", "name") if parts > 1 else stored


def similar_titles(
    left: DataFrame,
    right: DataFrame,
    block: str,
    name: str,
    threshold: float | None = None,
    edits: int | None = None,
    q: int = 2,
    most: int = SLICE,
    work: Workspace | None = None,
) -> DataFrame:
    """Pairs of canonical names of two tables, by ``threshold`` (Jaccard, of grams) or by ``edits``; equal names included. Rows
    without a block or a name have no pairs, copies of a name count once. With ``work`` names are stored there, once for a table that is
    joined with itself, and spread over tasks."""
    if (threshold is None) == (edits is None):
        raise ValueError("give a threshold or a number of edits")
    a = _spread(distinct_names(left, block, name), work)
    b = a if right is left and work else _spread(distinct_names(right, block, name), work)
    if threshold is not None:
        return alike_by_grams(a, b, threshold, q, most)
    return alike_by_edits(a, b, edits, q, most)
