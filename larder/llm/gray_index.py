"""Hierarchical index of 64-bit fingerprints in Gray order, for links of a few differing bits.

Fingerprints are sorted by their rank in the reflected Gray code, where neighbours share many bits. Each run
of neighbours gets a node that holds the bits all of them share (mask and pattern); runs of nodes get
nodes above them in the same way, and each node keeps only the bits its parent does not have yet. A search
walks down and adds up the differing bits; a whole group is left out as soon as the sum is too large.
"""

from __future__ import annotations

import numpy as np

FAN = 16
SMALL = 64  # groups up to this size are searched together
QUERIES = 256  # of a larger group at a time
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray code: bit i is the parity of the bits from i upwards."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


class GrayIndex:
    """Index over several groups at once; ``group`` is sorted, and nodes never span two groups.

    ``levels[0]`` are the leaves' nodes, the last level has one node per group.
    """

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), group))
        self.order, self.codes = order, codes[order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # first child (and end), mask, pattern
        group, mask, pattern = group[order], np.full(len(codes), ALL), self.codes
        while True:
            begin = runs(group)
            within = np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group))))
            first = np.flatnonzero(within % FAN == 0)
            shared = np.bitwise_and.reduceat(mask, first) if len(first) else mask
            differ = (
                np.bitwise_or.reduceat(pattern, first) ^ np.bitwise_and.reduceat(pattern, first)
                if len(first)
                else pattern
            )
            shared = shared & ~differ
            pattern = pattern[first] & shared
            self.levels.append((np.append(first, len(group)), shared, pattern))
            done = len(begin) == len(first)
            group, mask = group[first], shared
            if done:
                break
        self.group_of_top = group

    def search(self, queries: np.ndarray, top: np.ndarray, most: int, skip=None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, position in ``codes``) at ``most`` differing bits or fewer, below node ``top`` of each query.

        ``skip(level, query, node)`` may name pairs that need not be followed.
        """
        query, node = np.arange(len(queries)), top
        known = np.zeros(len(queries), np.uint64)  # bits compared so far
        away = np.zeros(len(queries), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            first, mask, pattern = self.levels[level]
            away = away + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node] & ~known)
            keep = away <= most
            if skip is not None:
                keep &= ~skip(level, query, node)
            query, node, away = query[keep], node[keep], away[keep]
            known = mask[node]
            count = first[node + 1] - first[node]
            below = np.repeat(first[node] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            query, known, away = np.repeat(query, count), np.repeat(known, count), np.repeat(away, count)
            node = below
        away = away + np.bitwise_count((queries[query] ^ self.codes[node]) & ~known)
        keep = away <= most
        return query[keep], node[keep]


def joined(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels after joining left[i] with right[i], and the pairs that were needed for it (a forest)."""
    chosen, live = [], np.arange(len(left))
    while True:
        a, b = label[left[live]], label[right[live]]
        differ = a != b
        live, low, high = live[differ], np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        if not len(live):
            break
        order = np.lexsort((low, high))
        pick = order[runs(high[order])]
        chosen.append(live[pick])
        parent = np.arange(len(label))
        parent[high[pick]] = low[pick]
        while True:
            further = parent[parent]
            if np.array_equal(further, parent):
                break
            parent = further
        label = parent[label]
    return label, np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def links(group: np.ndarray, codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each group: enough pairs (as codes) to connect all that are connected, never all pairs.

    ``codes`` are distinct within a group. Memory grows with the number of codes, not of pairs: a large group is
    searched for some codes at a time, and parts of the index that are connected with a code already are left out.
    """
    order = np.argsort(group, kind="stable")
    group, codes = group[order], codes[order]
    starts = runs(group)
    sizes = np.diff(np.append(starts, len(group)))
    small = np.repeat(sizes <= SMALL, sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    numbers = np.repeat(np.arange(len(sizes)), sizes)
    some, some_group = codes[small], numbers[small]
    if len(some):
        index = GrayIndex(some_group, some)
        top = np.searchsorted(index.group_of_top, some_group[index.order])
        label = np.arange(len(some))
        for at in range(0, len(some), 1 << 14):
            query, node = index.search(index.codes[at : at + (1 << 14)], top[at : at + (1 << 14)], most)
            query = query + at
            keep = query < node
            query, node = query[keep], node[keep]
            label, needed = joined(label, query, node)
            found.append((index.codes[query[needed]], index.codes[node[needed]]))

    for k in np.flatnonzero(sizes > SMALL):
        index = GrayIndex(np.zeros(sizes[k], np.int64), codes[starts[k] : starts[k] + sizes[k]])
        label = np.arange(sizes[k])
        for at in range(0, sizes[k], QUERIES):
            uniform = []  # by level: the label of all codes below a node, -1 if they differ
            values = label
            for first, _, _ in index.levels:
                low, high = np.minimum.reduceat(values, first[:-1]), np.maximum.reduceat(values, first[:-1])
                values = np.where(low == high, low, -1)
                uniform.append(values)

            def skip(level, query, node, own=label[at : at + QUERIES], uniform=uniform):
                return uniform[level][node] == own[query]

            queries = index.codes[at : at + QUERIES]
            query, node = index.search(queries, np.zeros(len(queries), np.int64), most, skip)
            label, needed = joined(label, query + at, node)
            found.append((queries[query[needed]], index.codes[node[needed]]))
    if not found:
        return codes[:0], codes[:0]
    return tuple(np.concatenate(side) for side in zip(*found))
