"""Mixing sources to target weights by systematic sampling, with DataFrame operations only.

Within a source every document has the same number of expected copies. Documents stand in the order of
their size, the expected copies are summed up along that order, one random offset per source is added,
and a document is emitted once for every integer that its stretch of the sum crosses. The order by size
spreads the choice evenly over short and long documents, so that the words taken come near the target.

The running sum needs no window over a whole source. Positions come from three levels, each a window
over small groups: sizes within a source, hash buckets within a size, rows within a bucket. A source or a
size with a third of all rows is spread over the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
ONE = 1 << 32  # a copy, in the units in which expected copies are added up without rounding


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per row of ``sizes`` (src, has, source_size): the words to take, ``target``.

    The amount to share out is ``share`` times all sizes. Sources in order, null last, take ``weights`` in
    turn. No target exceeds ``most`` times the size; what is over goes to the others by weight, until none
    is above. Where the shares stop shrinking is found at once: with the sources sorted by cap over
    weight, a source is capped if the level at which the rest share what is left reaches its cap.
    """
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(W.unboundedPreceding, -1)
    turn = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")
    )
    rows = (
        sizes.withColumn("place", F.row_number().over(W.orderBy(F.col("has").desc(), "src")))
        .withColumn("weight", turn)
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    )
    rows = rows.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("budget"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("served"),
    ).withColumn("level", (F.col("budget") - F.col("capped")) / (F.col("weights") - F.col("served")))
    # The level rises while sources are capped and falls behind the first that isn't: the highest is the one that holds.
    target = F.least("cap", F.max("level").over(everything) * F.col("weight"))
    return rows.select("src", "has", "source_size", target.alias("target"))


def copies(
    docs: DataFrame,
    key: str,
    text: str,
    source: str,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    buckets: int = 256,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``size`` (words), ``source_size``, ``target``, ``copies`` and ``carry``.

    Reruns give the same copies: the order is by size, then by a hash of the key with ``seed``, then by
    hashes of the text and of the columns to ``carry``. Rows equal in all of these are alike, so which of them is taken makes no
    difference. A null text has no words, a null source is a source of its own, null keys count as equal
    keys. A source without words has target 0 and takes no copies. ``buckets`` (a power of 16) bounds the
    rows of one size that meet in a window: a bucket holds about one in ``buckets`` of them.
    """
    digits = len(f"{buckets:x}") - 1
    if 16**digits != buckets:
        raise ValueError("buckets must be a power of 16")
    if share > most or min(weights) <= 0:
        raise ValueError("share must not exceed most, and weights must be positive")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    base = docs.select(
        F.col(key).alias("_key"),
        word_count(F.col(text)).alias("size"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.col(source).isNotNull().alias("has"),
        order.alias("_order"),
        F.xxhash64(F.col(text)).alias("_tie"),
        # A null is not the same as nothing: it must not let the hashes of two columns change places.
        F.xxhash64(*(x for c in carry for x in (F.col(c).isNull(), F.col(c)))).alias("_others") if carry else F.lit(0).alias("_others"),
        *(F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)),
    ).withColumn("bucket", F.substring("_order", 1, digits))

    bucketed = stored(base.groupBy("src", "has", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sized = bucketed.groupBy("src", "has", "size").agg(F.sum("n").alias("n"))
    by_size = W.partitionBy("src", "has").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    by_bucket = W.partitionBy("src", "has", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sources = source_targets(
        sized.groupBy("src", "has").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, most
    )
    firsts = sized.select(
        "src", "has", "size", F.coalesce(F.sum("n").over(by_size), F.lit(0)).alias("smaller")
    ).join(sources, ["src", "has"])
    starts = bucketed.select(
        "src", "has", "size", "bucket", F.coalesce(F.sum("n").over(by_bucket), F.lit(0)).alias("earlier")
    ).join(firsts, ["src", "has", "size"])

    within = W.partitionBy("src", "has", "size", "bucket").orderBy("_order", "_key", "_tie", "_others")
    offset = F.conv(
        F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.col("has").cast("string"), F.lit("/"), F.col("src"))), 1, 8), 16, 10
    ).cast("decimal(38,0)")
    each = F.floor(
        F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)) * F.lit(float(ONE))
    ).cast("bigint")
    rows = (
        base.withColumn("_row", F.row_number().over(within))
        .join(starts, ["src", "has", "size", "bucket"])
        .withColumn("_at", F.col("smaller") + F.col("earlier") + F.col("_row"))
        .withColumn("_each", each.cast("decimal(20,0)"))
        .withColumn("_offset", offset)
    )
    crossed = lambda at: F.expr(f"(_each * cast({at} as decimal(18,0)) + _offset) div {ONE}")
    return rows.select(
        F.col("_key").alias(key),
        "size",
        "source_size",
        "target",
        (crossed("_at") - crossed("_at - 1")).cast("bigint").alias("copies"),
        *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)),
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``copies`` says. The columns stay as they are."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: inner[i] for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*inner)
    taken = copies(plain, at[key], at[text], at[source], carry=[c for c in inner if c != at[key]], **settings)
    return (
        taken.where("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*(F.col(at[c]).alias(c) for c in docs.columns))
    )
