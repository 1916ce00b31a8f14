"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.store import stored

MOST_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of any order to (node, root), for every node that has a link to another one; ``root`` is the
    smallest node it is connected with.

    Each round hangs all larger neighbours of a node on the smallest one around it, then does the same with
    the smaller neighbours, so long chains shrink fast. Minima are taken by partial aggregates, so a node
    with very many links is no burden; every round is written down, so lost executors cost at most one.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges, before = stored(edges, "links"), None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
            .select(F.col("x.a").alias("a"), F.col("x.m").alias("b"))
            .where("a > b")
            .distinct()
        )
        edges = stored(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
