"""Words of whole texts, encoded in bounded blocks of rows inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 8 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """``codes[offsets[i]:offsets[i + 1]]`` are the words of text ``i``, as positions in ``words``."""

    words: pa.Array
    codes: np.ndarray
    offsets: np.ndarray


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut and never merged, so that each has one row or at most ``limit`` bytes of text."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def merged(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """As ``blocks``, with small neighbours put together up to ``limit`` bytes."""
    held, size = [], 0
    for part in blocks(batches, column, limit):
        more = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if held and size + more > limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(part)
        size += more
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def encode(texts: pa.Array) -> Words:
    """Words between ASCII white space, A-Z lower-cased; a null text has none."""
    return encode_exact(pc.ascii_lower(pc.fill_null(texts, "")))


def encode_exact(texts: pa.Array) -> Words:
    """As ``encode``, with the words as they are written."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    ends = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.values.slice(ends[0], ends[-1] - ends[0])
    full = np.asarray(pc.binary_length(flat)) > 0
    before = np.concatenate([[0], np.cumsum(full)])
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return Words(coded.dictionary, np.asarray(coded.indices, dtype=np.int32), before[ends - ends[0]])


def raw(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words in a row, and where each begins (one more entry for the end)."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = words.buffers()
    starts = np.frombuffer(starts, np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of SplitMix64)."""
    values = values.astype(np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(count: int) -> np.ndarray:
    """1, MIX, MIX^2, ... modulo 2^64."""
    steps = np.full(count, MIX, np.uint64)
    if count:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per word, from its bytes alone."""
    data, starts = raw(words)
    sizes = np.diff(starts)
    within = np.arange(len(data)) - np.repeat(starts[:-1], sizes)
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max(initial=0)))[within]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    return mixed(sums[starts[1:]] - sums[starts[:-1]] + np.uint64(seed * int(MIX) % 2**64))
