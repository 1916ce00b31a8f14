"""Groups of spelling variants, found with blocked Gram matrices.

Two words that differ by one inserted, deleted or replaced letter have letter counts whose squared distance is at most two: one for
lengths that differ by one, two for equal lengths. Distances of all pairs of two blocks come from one matrix product,
|a|^2 + |b|^2 - 2ab, and the pairs that are near enough are verified letter by letter.

A block is a length, split further into cells: letters are dealt to a few classes, and a cell has the same number of letters of
each class. One edit adds one to one class, or moves one between two classes, so a word need only meet its own cell and those
neighbours, and each pair of cells meets once. The number of classes grows with the logarithm of the
number of words. A cell of more than ``SLICE`` words (permutations of the same letters) is dealt to several tasks.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.store import stored
from larder.llm.words import blocks

LEAST = 6  # letters of a word
SEEN = 5  # occurrences of a word
TIMES = 5  # how much more frequent a form is
SLICE = 8192  # words of a cell that meet others in one task
CHUNK = 1024  # words of a neighbour cell that are multiplied at once
HELD = 200_000  # different words that a task counts before it passes them on
MOST_ROUNDS = 40

# Letters of a word, lower case in ASCII, are a-z and the 64 code points from U+00C0, as one byte each in Latin-1.
LETTERS = "a-zÀ-ÿ"
DIMENSIONS = 90
AXIS = np.zeros(256, np.int64)
AXIS[ord("a") : ord("z") + 1] = np.arange(26)
AXIS[0xC0:] = np.arange(26, 90)


def misspelt(key: object, word: str, every: int) -> str:
    """The word, or for one of ``every`` hashes of key and word what is left without one of its letters."""
    h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
    if h % every:
        return word
    spot = h % len(word)
    return word[:spot] + word[spot + 1 :]


def word_counts(docs: DataFrame, key: str, text: str, every: int | None = None, least: int = LEAST) -> DataFrame:
    """``word`` and ``n``: words of at least ``least`` letters in all texts, A-Z lower-cased, with their occurrences.

    With ``every``, words are changed as ``misspelt`` says. Null and empty texts have no words, a null key counts as empty text,
    repeated rows count again. Counts are summed up in the tasks first, so a word that is everywhere is one row a task.
    """
    pattern = re.compile(f"[{LETTERS}]{{{least},}}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed_on() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return found

        counts: Counter[str] = Counter()
        for rows in blocks(batches, "text"):
            for one, value in zip(rows.column("key").to_pylist(), rows.column("text").to_pylist()):
                if not value:
                    continue
                found = Counter(pattern.findall(value.encode().lower().decode()))
                if every is None:
                    counts.update(found)
                else:
                    begin = zlib.crc32(f"{'' if one is None else one}:".encode())
                    for word, n in found.items():
                        if zlib.crc32(word.encode(), begin) % every == 0:
                            word = misspelt(one, word, every)
                            if len(word) < least:
                                continue
                        counts[word] += n
                if len(counts) >= HELD:
                    yield passed_on()
        if counts:
            yield passed_on()

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def classes_for(words: int) -> int:
    """Letter classes for so many words: three at least, one more for every eight times as many."""
    return max(3, round(math.log(max(words, 1), 8)))


def cell_counts(word: Column, classes: int) -> Column:
    """Letters of each class: code points modulo ``classes``."""
    kinds = ["".join(c for c in _alphabet() if ord(c) % classes == k) for k in range(classes)]
    return F.array(*[F.length(word) - F.length(F.translate(word, kind, "")) for kind in kinds])


def _alphabet() -> list[str]:
    return [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]


def _moves(classes: int) -> list[tuple[int, list[int]]]:
    """How a word visits cells: 0 its own; 1 those with a letter of one class turned into one of a later class; 2 those with one more letter."""
    unit = lambda i: [int(k == i) for k in range(classes)]
    same = [(1, [a - b for a, b in zip(unit(i), unit(j))]) for i in range(classes) for j in range(i)]
    return [(0, [0] * classes), *same, *[(2, unit(i)) for i in range(classes)]]


def visits(words: DataFrame, classes: int, most: int = SLICE) -> DataFrame:
    """Each word at its own cell (``role`` 0) and as a guest at half of the neighbour cells (1: equal length, 2: words there are one
    longer), so that each pair of cells meets once. Cells of more than ``most`` words come in slices: own words are dealt
    to them and are guests of the slices before, other guests visit all."""
    # Spread out again: few files of words become many visits.
    placed = words.repartition("word").withColumn("own", cell_counts(F.col("word"), classes))
    moves = F.array(*[F.struct(F.lit(r).alias("role"), F.array(*map(F.lit, m)).alias("move")) for r, m in _moves(classes)])
    rows = placed.select("word", "n", "own", F.explode(moves).alias("visit"))
    code = lambda c: F.array_join(c, ".")
    at = F.zip_with("own", "visit.move", lambda a, b: a + b)
    rows = rows.select("word", "n", "visit.role", code(at).alias("cell"), F.lit(0).alias("slice"))
    rows = rows.where(~F.contains("cell", F.lit("-")))
    large = placed.groupBy(code(F.col("own")).alias("cell")).agg(F.count(F.lit(1)).alias("size"))
    large = stored(large.where(F.col("size") > most), "large-cells")
    if large.isEmpty():
        return rows
    parts = large.select("cell", F.ceil(F.col("size") / most).cast("int").alias("parts"))
    rows = rows.drop("slice").join(parts, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("home", F.when(F.col("role") == 0, F.pmod(F.xxhash64("word"), F.col("parts"))))
    last = F.coalesce("home", F.col("parts") - 1)
    rows = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    role = F.when((F.col("role") == 0) & (F.col("slice") < F.col("home")), 1).otherwise(F.col("role"))
    return rows.select("word", "n", role.cast("int").alias("role"), "cell", "slice")


class Block:
    """Words of one length: letters as a matrix, and letter counts."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = words, np.array(counts, np.int64)
        self.length = len(words[0])
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), self.length)
        spots = np.arange(len(words))[:, None] * DIMENSIONS + AXIS[self.letters]
        self.vectors = np.bincount(spots.ravel(), minlength=len(words) * DIMENSIONS).reshape(-1, DIMENSIONS)
        # Twice the square of the length stays below 2^24, so that all whole numbers are exact.
        self.vectors = self.vectors.astype(np.float32 if self.length < 2000 else np.float64)
        self.squares = (self.vectors**2).sum(axis=1)


def near_pairs(home: Block, guests: Block, own: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places (home, guest) of the pairs that are one edit apart; ``own``: both are the same block, each pair once."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, len(guests.words), CHUNK):
        part = slice(at, at + CHUNK)
        products = home.vectors @ guests.vectors[part].T
        squared = home.squares[:, None] + guests.squares[None, part] - 2 * products
        # Equal lengths: even, and 0 for the same letters in another order. Else: odd.
        left, right = np.nonzero(squared == (2 if home.length == guests.length else 1))
        right += at
        if own:
            left, right = left[left < right], right[left < right]
        for begin in range(0, len(left), 1 << 18):
            i, j = left[begin : begin + (1 << 18)], right[begin : begin + (1 << 18)]
            a, b = home.letters[i], guests.letters[j]
            if home.length == guests.length:
                good = (a != b).sum(axis=1) == 1
            else:
                front, rear = a[:, :-1] == b, a[:, 1:] == b
                size = guests.length
                heads = np.where(front.all(axis=1), size, front.argmin(axis=1))
                tails = np.where(rear.all(axis=1), size, rear[:, ::-1].argmin(axis=1))
                good = heads + tails >= size
            found.append((i[good], j[good]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def summed_up(one: Block, other: Block, i: np.ndarray, j: np.ndarray) -> list[tuple]:
    """For words of ``one`` that are near to words of ``other``: word, n, near words, the most frequent of these, its n."""
    if not len(i):
        return []
    names = np.ascontiguousarray(other.letters).view(f"S{other.length}").ravel()
    order = np.lexsort((names[j], -other.n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    sizes = np.diff(np.append(first, len(i)))
    return [
        (one.words[a], int(one.n[a]), int(size), other.words[b], int(other.n[b]))
        for a, b, size in zip(i[first].tolist(), j[first].tolist(), sizes.tolist())
    ]


NEAR = "word string, n long, n_near long, near string, near_n long"


def near_words(words: DataFrame, classes: int, most: int = SLICE) -> DataFrame:
    """Near words of each word, cell by cell: rows of ``NEAR``, several for a word, one at least."""
    rows = visits(words, classes, most).repartition("cell", "slice").sortWithinPartitions("cell", "slice", "role")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def met() -> None:
            """Home words with each other, or with the guests that are held."""
            nonlocal home, held
            if not held:
                return
            if role == 0:
                home = Block([w for w, _ in held], [n for _, n in held])
                found.extend((w, n, 0, None, None) for w, n in held)
                i, j = near_pairs(home, home, own=True)
                found.extend(summed_up(home, home, np.concatenate([i, j]), np.concatenate([j, i])))
            elif home is not None:
                guests = Block([w for w, _ in held], [n for _, n in held])
                i, j = near_pairs(home, guests)
                found.extend(summed_up(home, guests, i, j))
                found.extend(summed_up(guests, home, j, i))
            held = []

        def passed_on() -> pa.RecordBatch:
            columns = list(zip(*found))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n", "n_near", "near", "near_n"]
            )
            found.clear()
            return batch

        place, role, home, held = None, 0, None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cell", "slice", "role", "word", "n")]
            for cell, part, kind, word, n in zip(*columns):
                if (cell, part) != place:
                    met()
                    place, role, home = (cell, part), kind, None
                elif kind != role:
                    met()
                    role = kind
                elif kind and len(held) == CHUNK:
                    met()
                if kind == 0 or home is not None:
                    held.append((word, n))
            if len(found) > HELD // 4:
                yield passed_on()
        met()
        if found:
            yield passed_on()

    return rows.select("cell", "slice", "role", "word", "n").mapInArrow(run, NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last one. Each round doubles the steps taken; rounds are stored."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = links.join(further, "root", "left")
        after = stored(found.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if after.where(F.col("next").isNotNull()).isEmpty():
            return after.drop("next")
        links = after.drop("next")
    raise RuntimeError(f"forms did not settle in {MOST_ROUNDS} rounds")


def group_variants(
    docs: DataFrame,
    key: str,
    text: str,
    every: int | None = None,
    least: int = LEAST,
    seen: int = SEEN,
    times: int = TIMES,
    most: int = SLICE,
) -> DataFrame:
    """Words of all texts that occur ``seen`` times: ``word``, ``n``, ``n_near`` (words one edit away), ``form`` (the most frequent of these,
    the first by code points among equals, if it is ``times`` as frequent as the word), ``form_n`` and ``root`` (the form of the form and
    so on, the word itself without one). Words are counted as in ``word_counts``; without words there are no rows.
    """
    words = word_counts(docs, key, text, every, least).where(F.col("n") >= seen)
    words = stored(words, "words")
    near = near_words(words, classes_for(words.count()), most)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("rank"), "near")))
    grouped = near.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    enough = -F.col("best.rank") >= times * F.col("n")
    grouped = stored(
        grouped.select(
            "word",
            "n",
            "n_near",
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.rank")).alias("form_n"),
        ),
        "variants",
    )
    last = roots(grouped.where(F.col("form").isNotNull()))
    joined = grouped.join(last, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
