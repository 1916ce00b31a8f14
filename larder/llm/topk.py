"""Exact top-k by inner product with norm-bucketed retrieval.

All vectors are sorted by length and packed into blocks, so a block is a bucket of similar lengths. A query first
sees the block of the longest vectors, which gives it a score its k-th result must reach. With that score, every other
block gives the query a cosine that a vector of the block would need: above one, the block is left out (length
pruning within and between blocks); above a limit, the query's largest coordinates are multiplied first and the vectors
that cannot reach the score are left out (coordinate pruning); else the block is cut by length alone. What is left is
verified by the full product.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.llm.store import stored

EXACT = 2.0**53


@dataclass(frozen=True)
class Settings:
    block_rows: int = 4096
    query_rows: int = 512
    block_bytes: int = 16 << 20
    coordinates: int = 16
    cosine: float = 0.35  # from here on coordinates prune better than length alone


def whole(batch: pa.RecordBatch, scale: float) -> list[np.ndarray]:
    """floor(scale * x) of each vector, as floats (exact: a double's floor is a whole number)."""
    values = batch.column("vector")
    flat = np.floor(scale * np.asarray(values.flatten(), dtype=np.float64))
    ends = np.asarray(values.offsets, dtype=np.int64) - values.offsets[0].as_py()
    return [flat[a:z] for a, z in zip(ends[:-1], ends[1:])]


def matrix(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of one width; shorter vectors are filled up with zeros, which changes no product."""
    width = max((len(x) for x in rows), default=0)
    found = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        found[i, : len(x)] = x
    return found


def packed(ids: list, rows: list[np.ndarray], number: int) -> dict[str, list]:
    values = matrix(rows)
    norms = np.sqrt((values**2).sum(axis=1)).max(initial=0.0)
    return {
        "block": [number],
        "longest": [float(norms)],
        "width": [values.shape[1]],
        "ids": [np.array(ids, np.int64).tobytes()],
        "values": [values.tobytes()],
    }


PACKED = "block long, longest double, width long, ids binary, values binary"


def pack(rows_limit: int, bytes_limit: int, scale: float | None):
    """Map function: sorted vectors to blocks. Without ``scale`` the components are whole already."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, rows, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for one, row in zip(batch.column("id").to_pylist(), whole(batch, scale or 1.0)):
                if rows and (len(rows) == rows_limit or size + 8 * len(row) > bytes_limit):
                    yield pa.RecordBatch.from_pydict(packed(ids, rows, number))
                    number, ids, rows, size = number + 1, [], [], 0
                ids.append(one)
                rows.append(row)
                size += 8 * len(row)
        if rows:
            yield pa.RecordBatch.from_pydict(packed(ids, rows, number))

    return run


def unpacked(ids: bytes, values: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, np.int64)
    return keys, np.frombuffer(values, np.float64).reshape(len(keys), width)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, exact: 64-bit numbers, or Python's where these might not do."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, width) < EXACT:
        return (left @ right.T).astype(np.int64)
    big = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    return big(left) @ big(right).T if width else np.zeros((len(left), len(right)), np.int64)


def shown(scores: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Scores within 64 bits, and how far those are beyond that do not fit."""
    if scores.dtype != object:
        return pa.array(scores.astype(np.int64)), pa.nulls(len(scores), pa.decimal128(38, 0))
    held = [min(max(int(x), -(2**63)), 2**63 - 1) for x in scores]
    beyond = [decimal.Decimal(min(max(int(x) - h, 1 - 10**38), 10**38 - 1)) for x, h in zip(scores, held)]
    return pa.array(held, pa.int64()), pa.array(beyond, pa.decimal128(38, 0))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, equal scores by id."""
    if len(scores) > 4 * k and scores.dtype != object:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= limit)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(query_ids, queries, ids, rows, floors, k: int, settings: Settings):
    """Per query, the ids and scores of a block that can be among its best k; ``floors``: the score each must reach."""
    lengths = np.sqrt((rows**2).sum(axis=1))
    longest = lengths.max(initial=0.0)
    own = np.sqrt((queries**2).sum(axis=1))
    width = min(queries.shape[1], rows.shape[1])
    safe = 1 + 1e-9  # for the rounding of bounds; the products themselves are exact
    for i in range(len(queries)):
        floor, reach = floors[i], own[i] * longest * safe
        if floor > reach:
            continue
        live = np.arange(len(rows))
        cosine = floor / reach if reach > 0 and np.isfinite(floor) else -1.0
        if cosine > 0:
            live = np.flatnonzero(own[i] * lengths * safe >= floor)
            if cosine >= settings.cosine and width > settings.coordinates:
                lead = np.argsort(-np.abs(queries[i, :width]), kind="stable")[: settings.coordinates]
                known = rows[np.ix_(live, lead)] @ queries[i, lead]
                # Cauchy-Schwarz for the coordinates that were not multiplied.
                rest = np.sqrt(np.maximum(lengths[live] ** 2 - (rows[np.ix_(live, lead)] ** 2).sum(axis=1), 0))
                tail = np.sqrt(max(own[i] ** 2 - (queries[i, lead] ** 2).sum(), 0.0))
                slack = 1e-9 * (own[i] * lengths[live] + 1)
                live = live[known + tail * rest + slack >= floor]
        live = live[ids[live] != query_ids[i]]
        if not len(live):
            continue
        scores = products(queries[i : i + 1], rows[live])[0]
        reached = scores >= floor
        live, scores = live[reached], scores[reached]
        top = best(ids[live], scores, k)
        yield i, ids[live][top], scores[top]


def top_k(
    points: DataFrame, key: str, vector: str, is_query, k: int = 20, scale: float = 64.0, settings: Settings = Settings()
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row whose key satisfies ``is_query`` the k highest inner
    products of floor(scale * component), equal scores by smaller key; all if there are fewer. Rows with the query's own
    key are no candidates.

    Rows with a null key, a null vector, or one with a null or non-finite component take no part. Rows that repeat a key are candidates
    each, and as queries they share one ranking of all their products. Vectors of different widths are compared over their common
    components. Scores beyond 64 bits are shown as the limit and ranked by their value (38 digits of it). Queries are taken against all rows in blocks; a task holds one block of each.
    """
    clean = (
        points.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .where("id is not null and vector is not null")
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    )
    sized = clean.withColumn("length", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    ordered = sized.repartitionByRange(F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
    blocks = stored(
        ordered.select("id", "vector").mapInArrow(pack(settings.block_rows, settings.block_bytes, scale), PACKED), "vectors"
    )

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows = unpacked(row["ids"], row["values"], row["width"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(list(rows), pa.list_(pa.float64()))], names=["id", "vector"]
                )

    asked = blocks.mapInArrow(chosen, "id long, vector array<double>").where(is_query(F.col("id")))
    queries = asked.mapInArrow(pack(settings.query_rows, settings.block_bytes, None), PACKED)

    # One block, of bounded size, goes to all tasks: that of the longest vectors.
    seed = blocks.orderBy(F.desc("longest"), "block").limit(1).collect()
    first = unpacked(seed[0]["ids"], seed[0]["values"], seed[0]["width"]) if seed else None

    def floors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows = unpacked(row["ids"], row["values"], row["width"])
                least = np.full(len(ids), -np.inf)
                for i, _, scores in search(ids, rows, *first, least, k, settings):
                    if len(scores) == k:
                        least[i] = scores[-1]
                lengths = np.sqrt((rows**2).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(least > 0, least / lengths, 0.0).min()
                yield pa.RecordBatch.from_pydict(
                    {c: [row[c]] for c in ("width", "ids", "values")}
                    | {"q": [row["block"]], "floors": [least.tobytes()], "need": [float(need) * (1 - 1e-9)]}
                )

    ready = stored(
        queries.mapInArrow(floors, "width long, ids binary, values binary, q long, floors binary, need double"), "queries"
    )
    # Which blocks a block of queries must see, from their sizes alone; then both are brought together.
    pairs = ready.select("q", "need").join(blocks.select("block", "longest"), F.col("longest") >= F.col("need"))
    work = (
        pairs.select("q", "block")
        .join(ready.select("q", F.struct("width", "ids", "values", "floors").alias("asked")), "q")
        .join(blocks.select("block", F.struct("width", "ids", "values").alias("held")), "block")
        .select("asked", "held")
    )

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                asked, held = batch.column("asked")[at].as_py(), batch.column("held")[at].as_py()
                query_ids, rows = unpacked(asked["ids"], asked["values"], asked["width"])
                ids, values = unpacked(held["ids"], held["values"], held["width"])
                least = np.frombuffer(asked["floors"], np.float64)
                hits = list(search(query_ids, rows, ids, values, least, k, settings))
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(query_ids[[i for i, _, _ in hits]], [len(x) for _, x, _ in hits])),
                            pa.array(np.concatenate([x for _, x, _ in hits])),
                            *shown(np.concatenate([s for _, _, s in hits])),
                        ],
                        names=["query_id", "vec_id", "score", "beyond"],
                    )

    hits = work.mapInArrow(found, "query_id long, vec_id long, score long, beyond decimal(38,0)")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.coalesce("beyond", F.lit(0)).desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
