"""Near duplicates by SimHash: fingerprints of word shingles that differ in a few bits are linked.

Fingerprints meet where some of their bit blocks agree: of ``blocks`` blocks at most ``most`` can hold a
differing bit, so two linked fingerprints agree in ``blocks - most`` of them, and are dealt to the same
group for that choice of blocks. Inside a group the Gray-order index finds the links. A group beyond
``group_rows`` is cut into slices, and each pair of slices is searched in a task of its own, so no task ever
holds more than two slices, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import gray_index
from larder.llm.components import components
from larder.llm.store import stored
from larder.llm.words import blocks as text_blocks

SEED = 42
BITS = 64
PART = 1 << 16  # shingles whose bits are unpacked at once


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words (all words if there are fewer), A-Z lower-cased, one space between."""
    words = text.lower().split()  # bytes split at and lower-case ASCII alone
    if not words:
        return np.zeros(0, np.uint64)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    found = [digest(line[a:z], SEED) for a, z in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())]
    return np.array(found, np.uint64)


def fingerprint(text: bytes, size: int) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it; no words give 0."""
    hashes = shingle_hashes(text, size)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), PART):
        part = hashes[at : at + PART].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, size: int, name: str) -> DataFrame:
    """All columns and the fingerprint as a signed 64-bit number. Rows stay where they are."""
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    names = rows.columns
    rows = rows.withColumn("text", F.col(names[docs.columns.index(text)]).cast("string"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            found = np.array([fingerprint(x, size) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(found)], names=[*names, "f"])

    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("f", T.LongType())])
    return rows.mapInArrow(run, schema).toDF(*docs.columns, name)


def masks(blocks: int, agree: int) -> list[int]:
    """The bits of each choice of ``agree`` out of ``blocks`` blocks, as signed numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    found = [sum(single[i] for i in chosen) for chosen in combinations(range(blocks), agree)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def linked(codes: DataFrame, most: int, blocks: int = 0, group_rows: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``f``) that connect all within ``most`` bits."""
    blocks = blocks or most + 2
    choices = masks(blocks, blocks - most)
    groups = F.array(*(F.struct(F.lit(i).alias("m"), F.col("f").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(choices)))
    dealt = codes.select("f", F.explode(groups).alias("g")).select("f", "g.m", "g.k")
    # Groups of one, by far the most, drop out here.
    counted = dealt.groupBy("m", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slices = F.ceil(F.col("n") / group_rows).cast("int")
    own = F.pmod(F.xxhash64("f"), F.col("slices")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("slices") - 1),
        lambda other: F.struct(F.least(F.col("own"), other).alias("s"), F.greatest(F.col("own"), other).alias("t")),
    )
    grouped = (
        dealt.join(counted, ["m", "k"])
        .withColumn("slices", slices)
        .withColumn("own", own)
        .select("f", "m", "k", F.explode(pairs).alias("p"))
        .groupBy("m", "k", "p.s", "p.t")
        .agg(F.collect_list("f").alias("codes"))
        .select("codes")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("codes")
            for part in cut(lists):
                sizes = np.diff(np.asarray(part.offsets))
                values = np.asarray(part.flatten()).view(np.uint64)
                a, b = gray_index.links(np.repeat(np.arange(len(sizes)), sizes), values, most)
                yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    return grouped.mapInArrow(run, "a long, b long")


def cut(lists: pa.ListArray, limit: int = 1 << 17) -> Iterator[pa.ListArray]:
    """The lists in stretches of about ``limit`` values."""
    ends = np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
    at = 0
    while at < len(lists):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield lists.slice(at, end - at)
        at = end


def labelled(prints: DataFrame, key: str, most: int) -> DataFrame:
    """(f, component_id, first): per distinct fingerprint of ``prints`` (key, f) the smallest key of its component,
    and the fingerprint that has it. Null keys are never the smallest, unless there is no other."""
    codes = stored(prints.groupBy("f").agg(F.min(key).alias("least")), "codes")
    roots = components(linked(codes.select("f"), most))
    rooted = codes.join(roots, codes.f == roots.node, "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    order = F.struct(F.col("least").isNull(), F.col("least"), F.col("f"))
    heads = rooted.groupBy("root").agg(F.min(order).alias("x")).select(
        "root", F.col("x.least").alias("component_id"), F.col("x.f").alias("first")
    )
    return stored(rooted.join(heads, "root").select("f", "component_id", "first"), "labels")


def cluster(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, most: int = 4) -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` for every row of ``docs``.

    Rows with equal fingerprints are one node, so copies are never paired. Null and empty texts have fingerprint
    zero and are linked like any other. Repeated keys are kept; a null key gets its row's component, and is
    its id only where all keys are null. Other columns are not read.
    """
    prints = with_fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", size, "f")
    prints = stored(prints.select("key", "f"), "prints")
    labels = labelled(prints, "key", most)
    return prints.join(labels, "f").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, most: int = 4) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest key (of repeated rows with that key and
    fingerprint, the one whose columns hash lowest). Columns stay as they are, whatever their names."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: inner[i] for i, c in enumerate(docs.columns)}
    rows = stored(with_fingerprints(docs.toDF(*inner), at[text], size, "f"), "prints", compression="zstd")
    own = F.col(at[key])
    heads = labelled(rows.select(own.alias("key"), "f"), "key", most).where("f = first").select("f", "component_id")
    kept = rows.join(heads, "f").where(own.eqNullSafe(F.col("component_id")))
    one = W.partitionBy("f").orderBy(F.xxhash64(*inner), *(F.col(c) for c in (at[key], at[text])))
    return kept.withColumn("n", F.row_number().over(one)).where("n = 1").select(*(F.col(at[c]).alias(c) for c in docs.columns))
