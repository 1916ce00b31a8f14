"""Document fingerprints from improbable features.

Every window of bytes has an entropy, and entropies that are seldom in the corpus make a window improbable. A
window that is the most improbable one of many stretches of neighbouring windows is a feature. Features go
into Bloom filters, a new one as soon as the last is full. Two fingerprints are alike as far as their filters
have more bits in common than chance gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.store import stored
from larder.llm.words import blocks

WINDOW = 64  # bytes of a window, and windows of a stretch
LEAST = 16  # stretches a window has to lead
BINS = 1001
WEAK = 100  # entropies below are near to constant bytes, and taken only where there is nothing else
BYTES = 256  # of a Bloom filter
FULL = 160  # features in a filter
HASHES = 5
CUT = 0.1  # share of the possible overlap beyond chance that counts as none
BLOCK_BYTES = 4 << 20
SEGMENT = 1 << 17  # bytes that are looked at together

# How the sum of c * log2(c) over the counts c of a window changes with one more of a byte of which there are c, in
# whole units, so that running sums stay exact.
UNIT = 1 << 20
PLOGP = np.array([0, *(round(c * np.log2(c) * UNIT) for c in range(1, WINDOW + 1))], np.int32)
MORE = np.diff(PLOGP)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of each full window, 0 to 1000 for 0 to 6 bits; entry i is the window that begins at i.

    When the window moves by one byte, two counts change: that of the byte that comes in and that of the one that
    goes. Both are numbers of equal bytes at the distances within a window.
    """
    if len(data) < WINDOW:
        return np.zeros(0, np.int32)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for step in range(1, WINDOW):
        same = (data[step:] == data[:-step]).view(np.uint8)
        before[step:] += same
        after[:-step] += same
    change = MORE[before]
    change[WINDOW:] -= MORE[after[: len(data) - WINDOW]]
    total = np.cumsum(change, dtype=np.int32)[WINDOW - 1 :]
    return ((6 * WINDOW * UNIT - total) * (1000 / (6 * WINDOW * UNIT))).astype(np.int32)


def leaders(ranks: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """How many stretches each window leads; ``inside``: per stretch, whether it counts. Leftmost wins."""
    keys = (ranks.astype(np.int32) << 20) + np.arange(len(ranks), dtype=np.int32)
    step = 1
    while step < WINDOW:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    return np.bincount(keys[inside] & 0xFFFFF, minlength=len(ranks))


def chosen(texts: list[bytes], table: np.ndarray) -> list[np.ndarray]:
    """Begins of the windows of each text that are features. ``table``: entropy to rank, improbable first.

    A text in which no window leads ``LEAST`` stretches, as it is too short for so many or always the same, has the most improbable of
    its windows. So every text of a window or more has a feature.
    """
    found: list[np.ndarray] = []
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) <= SEGMENT:
        ranks = table[entropies(data)]
        own = np.repeat(ends, sizes)  # end of the text of each byte
        stretch = np.arange(max(0, len(ranks) - WINDOW + 1))
        led = leaders(ranks, own[stretch] - stretch >= 2 * WINDOW - 1) if len(stretch) else np.zeros(len(ranks), int)
        taken = np.flatnonzero(led >= LEAST)
        edges = np.searchsorted(taken, np.append(0, ends))
        for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
            begin = end - size
            own_taken = taken[edges[i] : edges[i + 1]] - begin
            if not len(own_taken) and size >= WINDOW:
                own_taken = np.array([np.argmin(ranks[begin : end - WINDOW + 1])])
            found.append(own_taken)
        return found
    for text in texts:  # long ones, a part at a time
        if len(text) <= SEGMENT:
            found += chosen([text], table)
            continue
        whole, led = np.frombuffer(text, np.uint8), np.zeros(len(text), np.uint8)
        rarest = (len(table), 0)
        for at in range(0, len(text) - 2 * WINDOW + 2, SEGMENT):
            ranks = table[entropies(whole[at : at + SEGMENT + 2 * WINDOW - 2])]
            led[at : at + len(ranks)] += leaders(ranks, np.ones(len(ranks) - WINDOW + 1, bool)).astype(np.uint8)
            first = int(np.argmin(ranks))
            rarest = min(rarest, (int(ranks[first]), at + first))
        taken = np.flatnonzero(led >= LEAST)
        found.append(taken if len(taken) else np.array([rarest[1]]))
    return found


class Print(NamedTuple):
    """Bloom filters as whole numbers, and how many features each holds."""

    bits: tuple[int, ...]
    counts: tuple[int, ...]


EMPTY = Print((), ())


def filters(text: bytes, begins: np.ndarray) -> Print:
    """Filters of the features that begin at ``begins``. A text shorter than a window is a feature as it is; an empty
    one has no filter. A feature counts once in a filter."""
    windows = [text[b : b + WINDOW] for b in begins.tolist()] if len(text) >= WINDOW else [text] * bool(text)
    if not windows:
        return EMPTY
    digest = xxhash.xxh3_128_digest
    keys = list(dict.fromkeys([digest(w) for w in windows]))
    parts = [keys]
    if len(keys) > FULL:
        parts = [[]]
        seen: set[bytes] = set()
        for w in windows:
            key = digest(w)
            if key not in seen:
                if len(seen) == FULL:
                    parts.append([])
                    seen = set()
                seen.add(key)
                parts[-1].append(key)
    words = np.frombuffer(b"".join(map(b"".join, parts)), "<u2").reshape(-1, 8)[:, :HASHES] % (8 * BYTES)
    counts = tuple(map(len, parts))
    bits = np.zeros((len(parts), 8 * BYTES), np.uint8)
    bits[np.repeat(np.arange(len(parts)), counts)[:, None], words] = 1
    packed = np.packbits(bits, axis=1).tobytes()
    return Print(tuple(int.from_bytes(packed[i : i + BYTES]) for i in range(0, len(packed), BYTES)), counts)


def written(found: Print) -> str:
    """Feature counts of the filters, then the filters themselves."""
    bits = b"".join(x.to_bytes(BYTES) for x in found.bits)
    return "-".join(map(str, found.counts)) + ":" + base64.b64encode(bits).decode()


def read(fingerprint: str) -> Print:
    counts, _, bits = fingerprint.partition(":")
    raw = base64.b64decode(bits)
    return Print(
        tuple(int.from_bytes(raw[i : i + BYTES]) for i in range(0, len(raw), BYTES)),
        tuple(int(x) for x in counts.split("-") if x),
    )


def one_sided(left: Print, right: Print) -> float:
    """Mean over the filters of ``left``, by their features, of the best match among those of ``right``."""
    sizes = [(b, b.bit_count()) for b in right.bits]
    total = 0.0
    for a, count in zip(left.bits, left.counts):
        size, best = a.bit_count(), 0.0
        for b, other in sizes:
            common, least, chance = (a & b).bit_count(), min(size, other), size * other / (8 * BYTES)
            floor = chance + CUT * (least - chance)
            if common > floor:
                best = max(best, (common - floor) / (least - floor))
            elif common == least:
                best = 1.0
        total += best * count
    return total / sum(left.counts)


def likeness(left: Print, right: Print) -> float:
    """0 to 1, the same both ways; equal fingerprints have 1, and an empty one is alike to an empty one only."""
    if left == right:
        return 1.0
    if not left.counts or not right.counts:
        return 0.0
    if len(left.counts) == len(right.counts):
        return (one_sided(left, right) + one_sided(right, left)) / 2
    return one_sided(*sorted((left, right), key=lambda x: len(x.counts)))


def batched(texts: list[bytes], limit: int = SEGMENT) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def fingerprints(texts: list[bytes], table: np.ndarray) -> list[Print]:
    return [
        filters(text, begins) for part in batched(texts) for text, begins in zip(part, chosen(part, table), strict=True)
    ]


def rarity(docs: DataFrame, text: str) -> np.ndarray:
    """Rank of each entropy, 0 for the one that fewest windows of all texts have. Counts of tasks are summed
    up by Spark; the driver gets one row per entropy."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for rows in blocks(batches, "text", BLOCK_BYTES):
            values = rows.column("text").cast(pa.binary()).drop_null().to_pylist()
            for part in batched(values):
                data = np.frombuffer(b"".join(part), np.uint8)
                ends = np.cumsum([len(x) for x in part])
                own = np.repeat(ends, [len(x) for x in part])
                for at in range(0, len(data), SEGMENT):
                    piece = entropies(data[at : at + SEGMENT + WINDOW - 1])
                    within = own[at : at + len(piece)] - np.arange(at, at + len(piece)) >= WINDOW
                    counts += np.bincount(piece[within], minlength=BINS)
        yield pa.RecordBatch.from_pydict({"bin": np.arange(BINS), "n": counts})

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bin long, n long")
    found = rows.groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BINS, np.int64)
    counts[found["bin"].to_numpy(int)] = found["n"].to_numpy(int)
    weak = np.arange(BINS) < WEAK
    ranks = np.empty(BINS, np.int64)
    ranks[np.lexsort((np.arange(BINS), counts, weak))] = np.arange(BINS)
    return ranks


def fingerprint_texts(docs: DataFrame, key: str, text: str, table: np.ndarray) -> DataFrame:
    """``key`` and ``fingerprint`` of every row, in place. Null texts count as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text", BLOCK_BYTES):
            found = fingerprints(rows.column("text").cast(pa.binary()).fill_null(b"").to_pylist(), table)
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), pa.array([written(x) for x in found])], names=["key", "fingerprint"]
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = [
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
]


def compared(keys: list, texts: list[str], after: list[str], prints: list, last, table: np.ndarray) -> dict[str, list]:
    """Result columns for texts, the texts after them, the prints of the texts and that of the last one's next."""
    changed = [edited(a, b).encode() for a, b in zip(texts, after, strict=True)]
    others = fingerprints(changed, table)
    following = [*prints[1:], last]
    return {
        "key": keys,
        "n_chars": [len(x) for x in texts],
        "edited_sha256": [hashlib.sha256(x).hexdigest() for x in changed],
        "fingerprint": [written(x) for x in prints],
        "edited_fingerprint": [written(x) for x in others],
        "near_edited": [likeness(a, b) for a, b in zip(prints, others)],
        "near_next": [likeness(a, b) for a, b in zip(prints, following)],
    }


def compare_neighbours(docs: DataFrame, key: str, text: str, table: np.ndarray) -> DataFrame:
    """Each text with its edited text and with the next one, in the order of ``key`` (null first, equal keys by a hash
    of the text, then the text); after the last comes the first.

    Rows are dealt by ranges of the key and read in order, so a task sees the next row without a window over
    all of them. Only the last row of a task has its next row elsewhere: it and the first row of each task are set
    aside and joined by task number. Null texts count as empty; a single row is its own next one. Returns
    ``key`` and the columns of ``RESULT``.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text").select("key", "text")
    ident = rows.schema["key"]
    schema = T.StructType(
        [
            T.StructField("task", T.LongType()),
            T.StructField("edge", T.IntegerType()),  # 0: result, 1: first text of a task, 2: last one
            ident,
            T.StructField("text", T.StringType()),
            *RESULT,
        ]
    )
    names = [f.name for f in RESULT]
    kind = {"n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def batch(task, edge, keys, texts, found) -> pa.RecordBatch:
        n = len(keys)
        columns = [pa.array([task] * n, pa.int64()), pa.array([edge] * n, pa.int32()), keys, pa.array(texts, pa.string())]
        columns += [pa.array(found.get(c, [None] * n), kind.get(c, pa.string())) for c in names]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, held = TaskContext.get().partitionId(), None
        for part in blocks(batches, "text", BLOCK_BYTES):
            keys, texts = part.column("key"), part.column("text").to_pylist()
            prints = fingerprints([x.encode() for x in texts], table)
            if held is None:
                yield batch(task, 1, keys.slice(0, 1), texts[:1], {})
            else:
                keys, texts, prints = pa.concat_arrays([held[0], keys]), [held[1], *texts], [held[2], *prints]
            held = (keys.slice(len(texts) - 1), texts[-1], prints[-1])
            if len(texts) > 1:
                found = compared([], texts[:-1], texts[1:], prints[:-1], prints[-1], table)
                yield batch(task, 0, keys.slice(0, len(texts) - 1), [None] * (len(texts) - 1), found)
        if held is not None:
            yield batch(task, 2, held[0], [held[1]], {})

    done = stored(rows.mapInArrow(run, schema), "digests", compression="zstd")

    # One row per task that had rows.
    tasks = done.where("edge = 1").select("task")
    ordered = W.orderBy("task")
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    following = tasks.select(
        "task", F.coalesce(F.lead("task").over(ordered), F.min("task").over(whole)).alias("next_task")
    )
    heads = done.where("edge = 1").select(F.col("task").alias("next_task"), F.col("text").alias("after"))
    ends = done.where("edge = 2").select("task", "key", "text").join(following, "task").join(heads, "next_task")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text", BLOCK_BYTES):
            texts, after = part.column("text").to_pylist(), part.column("after").to_pylist()
            for i, (a, b) in enumerate(zip(texts, after)):
                prints = fingerprints([a.encode(), b.encode()], table)
                found = compared([], [a], [b], prints[:1], prints[1], table)
                columns = [part.column("key").slice(i, 1)] + [pa.array(found[c], kind.get(c, pa.string())) for c in names]
                yield pa.RecordBatch.from_arrays(columns, names=["key", *names])

    last = ends.select("key", "text", "after").mapInArrow(finish, T.StructType([ident, *RESULT]))
    return done.where("edge = 0").select("key", *names).unionByName(last).withColumnRenamed("key", key)
