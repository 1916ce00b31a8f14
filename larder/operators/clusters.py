"""Groups of linked records, over any number of sources.

Links are followed on: if a is linked with b and b with c, all three are one group, though a and c may be far apart. Groups are
connected components of names, not of records: copies of a name are one node, so links do not grow with the number
of records.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import canonical, is_filled
from larder.operators.linkage import first_filled, similar_names
from larder.sources.workspace import Workspace

MOST_ROUNDS = 60


def connected(links: DataFrame, left: str, right: str, work: Workspace) -> DataFrame:
    """Connected components of undirected links: (``node``, ``root``) for each node with a link to another one, where ``root`` is the
    smallest node of its component. Nodes may be of any type that has an order; links with a NULL are no links.

    Each round has two steps. First every node tells its larger neighbours the smallest node it knows, then every node hangs itself
    and all it points to on the smallest of these. Paths at least halve, so a chain of n nodes takes about log2(n) rounds. Minima are
    partial aggregates. Each round is stored and the one before removed.
    """
    down = links.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("root"))
    complete = links[left].isNotNull() & links[right].isNotNull()
    stars = work.store(down.where(complete & (F.col("node") != F.col("root"))).distinct(), "links")
    mark = None
    for _ in range(MOST_ROUNDS):
        around = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        smallest = around.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        told = around.join(smallest, "node").where(F.col("root") > F.col("node"))
        told = told.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        lowest = told.groupBy("node").agg(F.min("root").alias("least"))
        hung = told.join(lowest, "node")
        pairs = F.array(
            F.struct(F.col("node"), F.col("least").alias("root")), F.struct(F.col("root").alias("node"), F.col("least").alias("root"))
        )
        hung = hung.select(F.inline(pairs)).where(F.col("node") != F.col("root")).distinct()
        before, stars = stars, work.store(hung, "links")
        work.remove(before)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if now == mark:
            roots = stars.select(F.col("root").alias("node"), "root").distinct()
            return stars.unionByName(roots)
        mark = now
    raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")


def source_names(sources: Sequence[DataFrame], block: str, name: str) -> DataFrame:
    """Canonical names of each block with the first and the last source (by position) that has them."""
    spelt = [df.select(F.col(block).alias("block"), F.col(name).alias("name")).distinct() for df in sources]
    placed = [df.withColumn("source", F.lit(place)) for place, df in enumerate(spelt)]
    names = reduce(DataFrame.unionByName, placed).withColumn("name", canonical(F.col("name")))
    names = names.where(F.col("block").isNotNull() & is_filled(F.col("name")))
    return names.groupBy("block", "name").agg(F.min("source").alias("first"), F.max("source").alias("last"))


def cross_source_links(names: DataFrame, edits: int) -> DataFrame:
    """Pairs of names at most ``edits`` apart, unless one and the same source alone has both."""
    spelt = names.select("block", "name")
    pairs = similar_names(spelt, spelt, edits).where(F.col("left_name") < F.col("right_name"))
    ends = {
        side: names.select("block", F.col("name").alias(f"{side}_name"), F.struct("first", "last").alias(f"{side}_in"))
        for side in ("left", "right")
    }
    met = pairs.join(ends["left"], ["block", "left_name"]).join(ends["right"], ["block", "right_name"])
    alone = (F.col("left_in") == F.col("right_in")) & (F.col("left_in.first") == F.col("left_in.last"))
    return met.where(~alone).select("block", "left_name", "right_name", "distance")


def golden_clusters(
    sources: Sequence[DataFrame],
    block: str,
    name: str,
    record_id: str,
    attributes: Sequence[str],
    edits: int,
    work: Workspace,
) -> DataFrame:
    """One record for each group of records that are linked, directly or over others.

    ``sources`` stand in order of priority. Records with the same canonical name in a block are one entity, and names of
    different sources at most ``edits`` apart are linked. Each attribute takes its first filled value: by source, then by record id. The
    group is called by the smallest name of its first source. Records without a block or a name cannot be linked and stay groups of
    their own.

    Records are merged per name and source before they meet the groups: the join holds each name once for each source.
    """
    records = [
        df.select(
            F.col(block).alias("block"),
            canonical(F.col(name)).alias("name"),
            F.lit(place).alias("priority"),
            F.col(record_id).cast("string").alias("record_id"),
            *attributes,
        )
        for place, df in enumerate(sources)
    ]
    rows = reduce(DataFrame.unionByName, records)
    linkable = F.col("block").isNotNull() & is_filled(F.col("name"))
    own = F.when(~linkable, F.concat_ws(":", F.col("priority").cast("string"), F.col("record_id")))
    rank = ("priority", "record_id")
    per_name = (
        rows.withColumn("own", own)
        .groupBy("block", "name", "priority", "own")
        .agg(F.count(F.lit(1)).alias("n_records"), *[first_filled(a, rank).alias(a) for a in attributes])
    )
    links = cross_source_links(work.store(source_names(sources, block, name), "names"), edits)
    node = lambda c: F.struct("block", F.col(c).alias("name"))
    groups = connected(links.select(node("left_name").alias("a"), node("right_name").alias("b")), "a", "b", work)
    groups = groups.select("node.block", "node.name", F.col("root.name").alias("root"))
    placed = per_name.join(groups, ["block", "name"], "left").withColumn("root", F.coalesce("root", "name"))
    merged = placed.groupBy("block", "root", "own").agg(
        F.min(F.struct("priority", "name")).alias("called"),
        F.sum("n_records").alias("n_records"),
        F.count_distinct("priority").alias("n_sources"),
        F.count_distinct("name").alias("n_names"),
        *[F.min(a).alias(a) for a in attributes],
    )
    values: list[Column] = [F.col(f"{a}.value").alias(a) for a in attributes]
    return merged.select("block", F.col("called.name").alias("name"), "n_records", "n_sources", "n_names", *values)
