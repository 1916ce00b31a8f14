"""Runs of repeated words, found with suffix trees.

A run is a stretch of words with a smallest period that repeats at least ``REPEATS`` times and cannot be made longer on either side.
Each run holds a Lyndon word of its period's length (its root) for one of two orders of the words: the usual one and its
reverse. So the longest Lyndon word that begins at each place, in both orders, gives all candidates. How far
a candidate's period goes on to the right and to the left are two longest common extensions: the depths of lowest common
ancestors in Ukkonen's suffix trees of the words and of the words reversed, taken from Euler tours in constant time.

Trees are built for the parts of a text that can hold a run (``stretches``). That choice is exact and leaves out most of
ordinary prose, where words do not come back in step.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.words import encode_exact, merged

REPEATS = 4
LEAST = 6  # words of a run
BLOCK_BYTES = 4 << 20
TILE = 32  # visits of a tour whose least depth is kept together


class Tree(NamedTuple):
    """Nodes of a suffix tree; 0 is the root. Edges are sorted by parent, then by their first word; those of ``node`` are
    ``edges[firsts[node]:firsts[node + 1]]``."""

    sizes: np.ndarray  # words on the edge that leads to each node
    edges: np.ndarray  # children
    firsts: np.ndarray
    last: np.ndarray  # whether a node's first edge is the end alone
    leaves: np.ndarray  # leaf of the suffix that begins at each word, then that of the end


def suffix_tree(codes: np.ndarray) -> Tree:
    """Ukkonen's construction, one word after the other, over numbers of words. An end smaller than every word is added."""
    word = (codes.astype(np.int64) + 1).tolist() + [0]
    n, width = len(word), int(codes.max(initial=0)) + 2
    begins, ends, links = array("i", [0]), array("i", [0]), array("i", [0])
    children: dict[int, int] = {}
    leaves = array("i")
    node = edge = length = left = 0
    for i, letter in enumerate(word):
        fresh, left = 0, left + 1
        while left:
            if not length:
                edge = i
            at = node * width + word[edge]
            child = children.get(at)
            if child is None:
                children[at] = len(begins)
                leaves.append(len(begins))
                begins.append(i)
                ends.append(n)
                links.append(0)
                if fresh:
                    links[fresh] = node
                    fresh = 0
            else:
                begin = begins[child]
                size = min(ends[child], i + 1) - begin
                if length >= size:
                    edge, length, node = edge + size, length - size, child
                    continue
                if word[begin + length] == letter:
                    length += 1
                    if fresh:
                        links[fresh] = node
                    break
                split = len(begins)
                children[at] = split
                begins.append(begin)
                ends.append(begin + length)
                links.append(0)
                children[split * width + letter] = split + 1
                leaves.append(split + 1)
                begins.append(i)
                ends.append(n)
                links.append(0)
                begins[child] = begin + length
                children[split * width + word[begin + length]] = child
                if fresh:
                    links[fresh] = split
                fresh = split
            left -= 1
            if node == 0 and length:
                length, edge = length - 1, i - left + 1
            elif node:
                node = links[node]
    keys = np.fromiter(children.keys(), np.int64, len(children))
    below = np.fromiter(children.values(), np.int32, len(children))
    order = np.argsort(keys)
    keys = keys[order]
    firsts = np.searchsorted(keys // width, np.arange(len(begins) + 1))
    last = np.zeros(len(begins), bool)
    last[keys[keys % width == 0] // width] = True
    sizes = np.array(ends, np.int32) - np.array(begins, np.int32)
    return Tree(sizes, below[order], firsts, last, np.array(leaves, np.int32))


class Tour:
    """Euler tour of a suffix tree. Children are visited in the order of their first words, or ``backwards`` in the reverse
    order; in both the end comes first."""

    def __init__(self, tree: Tree, backwards: bool = False):
        edges, firsts, sizes, last = tree.edges.tolist(), tree.firsts.tolist(), tree.sizes.tolist(), tree.last.tolist()
        visits, depths, seen = array("i"), array("i", bytes(4 * len(sizes))), array("i", bytes(4 * len(sizes)))
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:  # back at a parent
                visits.append(depths[~node])
                continue
            seen[node], depth = len(visits), depths[node]
            visits.append(depth)
            below = edges[firsts[node] : firsts[node + 1]]
            # What is pushed last comes first.
            if not backwards:
                below.reverse()
            elif last[node]:
                below.append(below.pop(0))
            for child in below:
                depths[child] = depth + sizes[child]
                stack.append(~node)
                stack.append(child)
        self.places = np.array(seen, np.int32)[tree.leaves]  # first visit of each suffix's leaf
        self.visits = np.array(visits, np.int32)
        tiles = np.pad(self.visits, (0, -len(visits) % TILE), constant_values=np.iinfo(np.int32).max).reshape(-1, TILE)
        self.heads = np.minimum.accumulate(tiles, axis=1).ravel()  # least depth of a tile up to each visit
        self.tails = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()  # ... from each visit on
        self.levels = [tiles.min(axis=1)]  # ... of 1, 2, 4, ... tiles
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            step = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``left`` and at ``right`` (elsewhere) have in common: the least depth between their
        leaves, that of the lowest common ancestor."""
        a, b = self.places[left], self.places[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        first, final = low // TILE, high // TILE
        found = np.minimum(self.tails[low], self.heads[high])
        near = np.flatnonzero(first == final)
        if len(near):
            spots = np.minimum(low[near, None] + np.arange(TILE), high[near, None])
            found[near] = self.visits[spots].min(axis=1)
        between = final - first - 1
        for k, level in enumerate(self.levels):
            rows = np.flatnonzero((between >= 1 << k) & (between < 2 << k))
            if len(rows):
                ends = np.minimum(level[first[rows] + 1], level[final[rows] - (1 << k)])
                found[rows] = np.minimum(found[rows], ends)
        return found


def lyndon_ends(places: np.ndarray) -> np.ndarray:
    """End of the longest Lyndon word that begins at each place: where the next smaller suffix begins."""
    ranks = places.tolist()
    ends = [0] * (len(ranks) - 1)
    for i in range(len(ends) - 1, -1, -1):
        j, rank = i + 1, ranks[i]
        while ranks[j] > rank:
            j = ends[j]
        ends[i] = j
    return np.array(ends, np.int64)


def runs_of(codes: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """Begin, length and period of all runs of a sequence of word numbers, sorted by begin, then period."""
    n = len(codes)
    numbers = np.unique(codes, return_inverse=True)[1]
    tree = suffix_tree(numbers)
    tour = Tour(tree)
    places = (tour.places, Tour(tree, backwards=True).places)
    del tree
    mirror = Tour(suffix_tree(numbers[::-1]))
    found = []
    for spots in places:
        begins, ends = np.arange(n), lyndon_ends(spots)
        periods = ends - begins
        right = tour.common(begins, ends)
        # Suffixes of the reversed words: the words before place i begin at n - i there.
        left = mirror.common(n - begins, n - ends)
        lengths = left + periods + right
        good = (lengths >= repeats * periods) & (lengths >= least)
        found.append(np.stack([begins - left, lengths, periods], axis=1)[good])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def stretches(codes: np.ndarray, offsets: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """(begin, end) of the parts of the texts ``codes[offsets[i]:offsets[i + 1]]`` outside of which there is no run.

    A word of a run with period q comes back within q words before or behind, and ``repeats`` times in the text. So
    for q of 2^k up to 2^(k+1) - 1 a run lies inside a row of at least ``repeats`` * 2^k words each of which comes back
    within 2^(k+1) - 1 words.
    """
    n, texts = len(codes), len(offsets) - 1
    if not n:
        return np.zeros((0, 2), np.int64)
    sizes = np.diff(offsets)
    keys = np.repeat(np.arange(texts, dtype=np.int64), sizes) * (int(codes.max()) + 1) + codes
    order = np.argsort(keys, kind="stable")
    fresh = np.append(True, keys[order[1:]] != keys[order[:-1]])
    groups = np.flatnonzero(fresh)
    uses = np.repeat(np.diff(np.append(groups, n)), np.diff(np.append(groups, n)))
    far = n + 1
    gaps = np.where(fresh, far, np.diff(order, prepend=0))
    near = np.minimum(gaps, np.append(gaps[1:], far))
    near[uses < repeats] = far
    back = np.empty(n, np.int64)
    back[order] = near
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    cover = np.zeros(n + 1, np.int32)
    for k in range(max(1, int(sizes.max()) // repeats).bit_length()):
        alive = np.concatenate([[False], back < 2 << k, [False]])
        begins = np.flatnonzero(alive[1:-1] & (~alive[:-2] | edge[:-1]))
        ends = np.flatnonzero(alive[1:-1] & (~alive[2:] | edge[1:])) + 1
        long = ends - begins >= max(least, repeats << k)
        cover += np.bincount(begins[long], minlength=n + 1).astype(np.int32)
        cover -= np.bincount(ends[long], minlength=n + 1).astype(np.int32)
    inside = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    begins = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return np.stack([begins, ends], axis=1)


Edit = Callable[[int, int], "np.ndarray | None"]


def find_runs(
    docs: DataFrame,
    key: str,
    text: str,
    salt: Column | None = None,
    edit: Edit | None = None,
    repeats: int = REPEATS,
    least: int = LEAST,
) -> DataFrame:
    """Per row, in place: ``key``, ``n_words`` (between ASCII white space), ``runs`` (array of ``start``, ``length``, ``period`` by start,
    then period) and ``collapsed``: the words joined by blanks, without those that a run repeats after its first period.

    ``edit(salt, n)`` may give the numbers of the original words that the text's n words become, in order; None leaves
    the text as it is, and so does a null salt. Null, empty and white texts have no words; equal rows have equal results; other
    columns are not read. A task holds a few MB of texts, or one longer text with its two trees (about 1 KB for each word inside
    ``stretches``).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in merged(batches, "text", BLOCK_BYTES):
            words, codes, offsets = encode_exact(rows.column("text"))
            if edit is not None:
                codes = codes.copy()
                for i, one in enumerate(rows.column("salt").to_pylist()):
                    own = codes[offsets[i] : offsets[i + 1]]
                    changed = None if one is None or not len(own) else edit(one, len(own))
                    if changed is not None:
                        own[:] = own[changed]
            found = [np.zeros((0, 3), np.int64) for _ in range(len(rows))]
            kept = np.ones(len(codes), bool)
            parts = stretches(codes, offsets, repeats, least)
            owners = np.searchsorted(offsets, parts[:, 0], side="right") - 1
            for (begin, end), owner in zip(parts.tolist(), owners.tolist()):
                runs = runs_of(codes[begin:end], repeats, least)
                for start, length, period in runs.tolist():
                    kept[begin + start + period : begin + start + length] = False
                runs[:, 0] += begin - offsets[owner]
                found[owner] = np.concatenate([found[owner], runs])
            ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
            lists = pa.LargeListArray.from_arrays(
                pa.array(ends, pa.int64()), pc.cast(words, pa.large_string()).take(pa.array(codes[kept]))
            )
            flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields),
                    pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                ],
                names=["key", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
        (F.lit(None) if salt is None else salt).cast("long").alias("salt"),
    )
    schema = T.StructType(
        [
            rows.schema["key"],
            *T._parse_datatype_string(
                "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
            ).fields,
        ]
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length over period; ties go to the first in the list. Null for no run."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(
        runs,
        none,
        lambda best, one: F.when(
            best.isNull() | (one["length"] * best["period"] > best["length"] * one["period"]), one
        ).otherwise(best),
    )


def digests(found: DataFrame, key: str) -> DataFrame:
    """Number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    rows = found.withColumn("best", strongest(F.col("runs")))
    return rows.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
