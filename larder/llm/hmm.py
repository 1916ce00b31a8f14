"""Hidden Markov language model: Baum-Welch counts over partitions, scaled forward recursion.

A word falls by its hash into one of a fixed number of classes. A hidden state emits a class, and the
class emits the word by its training count, so the state parameters have a size that does not grow
with the corpus, while the word counts, which do, stay a distributed table. Each class keeps one more
type for words not seen in training, so that the probabilities of all texts add up to one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import words as W
from larder.llm.store import stored

END = "\n"  # white space, so no word is equal to it
ADD = 0.1


@dataclass(frozen=True)
class Settings:
    """``iterations`` passes of Baum-Welch over all training texts; the other values size the model."""

    states: int = 8
    classes: int = 1 << 16
    iterations: int = 3
    stay: float = 0.95
    spread: float = 0.5
    prior: float = 20.0
    seed: int = 7
    block_bytes: int = 12 << 20


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # class x state, probability of the class in the state
    inside: np.ndarray  # class: what the add-one-tenth counts of its words are divided by
    total: int  # training tokens
    distinct: int


class Layout:
    """Texts of a block ordered by time: row ``begin[t] + i`` is word t of the i-th longest text."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.order]
        firsts = np.concatenate([[0], np.cumsum(lengths)])[:-1][self.order]
        longest = int(ordered[0]) if len(ordered) else 0
        # texts longer than t, for each t
        self.active = len(ordered) - np.searchsorted(ordered[::-1], np.arange(longest), side="right")
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        time = np.repeat(np.arange(longest), self.active)
        text = np.arange(len(time)) - self.begin[time]
        self.text, self.time = text, time
        self.token = firsts[text] + time


def forward(layout: Layout, emitted: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """State probabilities given the words so far, and each word's probability given those before it."""
    alpha, scale = np.empty_like(emitted), np.empty(len(emitted), emitted.dtype)
    start, step = model.start.astype(emitted.dtype), model.step.astype(emitted.dtype)
    begin, ones = layout.begin.tolist(), np.ones(len(start), emitted.dtype)
    last = None
    for t in range(len(begin) - 1):
        a, z = begin[t], begin[t + 1]
        now = alpha[a:z]
        if last is None:
            np.multiply(emitted[a:z], start, out=now)
        else:
            np.matmul(last[: z - a], step, out=now)
            now *= emitted[a:z]
        total = np.matmul(now, ones, out=scale[a:z])
        now /= total[:, None]
        last = now
    return alpha, scale


def backward(layout: Layout, emitted: np.ndarray, scale: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scaled backward values, and what stands right of the step into each word."""
    beta, into = np.ones_like(emitted), emitted / scale[:, None]
    back = np.ascontiguousarray(model.step.T.astype(emitted.dtype))
    begin = layout.begin.tolist()
    for t in range(len(begin) - 2, 0, -1):
        a, z = begin[t], begin[t + 1]
        right = into[a:z]
        right *= beta[a:z]
        np.matmul(right, back, out=beta[begin[t - 1] : begin[t - 1] + z - a])
    return beta, into


def expected(codes, lengths, classes, model: Model):
    """Expected counts of starts, steps and (for each word of the block) emissions."""
    layout = Layout(lengths)
    tokens = codes[layout.token]
    emitted = model.emit.astype(np.float32)[classes][tokens]
    alpha, scale = forward(layout, emitted, model)
    beta, into = backward(layout, emitted, scale, model)
    first = layout.active[0] if len(layout.active) else 0
    later = np.arange(first, len(tokens))
    before = layout.begin[layout.time[later] - 1] + layout.text[later]
    steps = model.step * (alpha[before].T @ into[later]).astype(np.float64)
    alpha *= beta
    emits = np.stack([np.bincount(tokens, alpha[:, k], len(classes)) for k in range(alpha.shape[1])], axis=1)
    return alpha[:first].sum(axis=0, dtype=np.float64), steps, emits


def log_likelihood(codes, lengths, classes, model: Model) -> np.ndarray:
    """log10 probability of each text's class sequence; exact up to rounding, whatever its length."""
    layout = Layout(lengths)
    emitted = model.emit[classes][codes[layout.token]]
    _, scale = forward(layout, emitted, model)
    found = np.zeros(len(lengths))
    found[layout.order] = np.bincount(layout.text, np.log10(scale), len(lengths))
    return found


def class_of(words: pa.Array, settings: Settings) -> np.ndarray:
    return (W.hashes(words, settings.seed) % np.uint64(settings.classes)).astype(np.int32)


def listed(values: pa.Array) -> pa.ListArray:
    """All values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def block_rows(settings: Settings):
    """Map function: documents to blocks with a word list of their own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, number = TaskContext.get().partitionId(), 0
        for rows in W.merged(batches, "text", settings.block_bytes):
            found = W.encode(rows.column("text"))
            lengths = np.diff(found.offsets) + 1
            codes = np.zeros(int(lengths.sum()), np.int32)
            word = np.ones(len(codes), bool)
            word[np.cumsum(lengths) - 1] = False
            codes[word] = found.codes + 1
            words = pa.concat_arrays([pa.array([END]), found.words.cast(pa.string())])
            learn = ~np.asarray(rows.column("held_out"))
            counts = np.bincount(codes[np.repeat(learn, lengths)], minlength=len(words))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [partition << 32 | number],
                    "keys": listed(rows.column("key")),
                    "held_out": listed(rows.column("held_out")),
                    "lengths": [lengths.astype(np.int32).tobytes()],
                    "codes": [codes.tobytes()],
                    "classes": [class_of(words, settings).tobytes()],
                    "words": listed(words),
                    "counts": [counts],
                }
            )
            number += 1

    return run


def count_rows(model: Model):
    """Map function: one Baum-Welch pass over the training texts of blocks.

    Rows with class -1 - k hold state k's steps, the row below those the starts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = len(model.start)
        start, steps, emits = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
        for batch in batches:
            for row in range(len(batch)):
                lengths = np.frombuffer(batch.column("lengths")[row].as_py(), np.int32).astype(np.int64)
                codes = np.frombuffer(batch.column("codes")[row].as_py(), np.int32)
                classes = np.frombuffer(batch.column("classes")[row].as_py(), np.int32)
                learn = ~np.asarray(batch.column("held_out")[row].values)
                more = expected(codes[np.repeat(learn, lengths)], lengths[learn], classes, model)
                start += more[0]
                steps += more[1]
                for k in range(states):
                    emits[:, k] += np.bincount(classes, more[2][:, k], len(emits))
        seen = np.flatnonzero(emits.any(axis=1))
        keys = np.concatenate([seen, [-1 - k for k in range(states)], [-1 - states]]).astype(np.int32)
        table = np.concatenate([emits[seen], steps, start[None]])
        yield pa.RecordBatch.from_pydict({"class": keys} | {f"e{k}": table[:, k] for k in range(states)})

    return run


def score_rows(model: Model):
    """Cogroup function: a block and the training counts of its words, to one row per text."""

    def run(block: pa.Table, counted: pa.Table) -> pa.Table:
        lengths = np.frombuffer(block.column("lengths")[0].as_py(), np.int32).astype(np.int64)
        codes = np.frombuffer(block.column("codes")[0].as_py(), np.int32)
        classes = np.frombuffer(block.column("classes")[0].as_py(), np.int32)
        counts = np.zeros(len(classes), np.int64)
        counts[np.asarray(counted.column("at"))] = np.asarray(counted.column("count"))
        plain = np.log10((counts + ADD) / (model.total + ADD * (model.distinct + 1)))
        inside = np.log10((counts + ADD) / model.inside[classes])
        text = np.repeat(np.arange(len(lengths)), lengths)
        sums = lambda values: np.bincount(text, values[codes], len(lengths))
        return pa.table(
            {
                "key": block.column("keys")[0].values,
                "held_out": block.column("held_out")[0].values,
                "n_tokens": lengths,
                "n_known": sums((counts > 0).astype(float)).astype(np.int64),
                "train_tokens": np.full(len(lengths), model.total),
                "base_score": sums(plain),
                "score": sums(inside) + log_likelihood(codes, lengths, classes, model),
            }
        )

    return run


def first_model(table: np.ndarray, settings: Settings) -> Model:
    """Start of training; ``table``: per class its tokens and its distinct words. States begin as random
    tilts of the class frequencies and tend to stay, so a text drifts to the state that fits it best."""
    tokens, distinct = table[:, 0], table[:, 1]
    inside = tokens + ADD * (distinct + 1)
    tilt = np.random.default_rng(settings.seed).normal(size=(settings.classes, settings.states))
    emit = (inside / inside.sum())[:, None] * np.exp(settings.spread * tilt)
    step = np.full((settings.states, settings.states), (1 - settings.stay) / max(1, settings.states - 1))
    np.fill_diagonal(step, settings.stay if settings.states > 1 else 1.0)
    start = np.full(settings.states, 1 / settings.states)
    return Model(start, step, emit / emit.sum(axis=0), inside, int(tokens.sum()), int(distinct.sum()))


def next_model(model: Model, found: dict[int, np.ndarray], settings: Settings) -> Model:
    """M-step: expected counts plus a little of what holds for all states."""
    states, share = settings.states, model.inside / model.inside.sum()
    emits = np.zeros_like(model.emit)
    keys = [c for c in found if c >= 0]
    if keys:
        emits[keys] = [found[c] for c in keys]
    zero = np.zeros(states)
    start = found.get(-1 - states, zero) + 1
    step = np.stack([found.get(-1 - k, zero) for k in range(states)]) + 1
    emits += settings.prior * share[:, None]
    return Model(
        start / start.sum(),
        step / step.sum(axis=1, keepdims=True),
        emits / emits.sum(axis=0),
        model.inside,
        model.total,
        model.distinct,
    )


def score_texts(docs: DataFrame, key: str, text: str, held_out: str, settings: Settings = Settings()) -> DataFrame:
    """Train on the rows whose ``held_out`` is not true, and score every row.

    Returns ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigram) and
    ``score`` (hidden Markov model), both log10. A null or empty text is its end alone. Null and
    repeated keys are kept, one result per row. Null ``held_out`` counts as false. With no training
    texts at all every word is unknown and the states keep their starting values. Other columns of
    ``docs`` are not read, whatever their names.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"),
    )
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("held_out", T.ArrayType(T.BooleanType())),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("codes", T.BinaryType()),
            T.StructField("classes", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    blocks = stored(rows.mapInArrow(block_rows(settings), schema), "hmm-blocks", compression="zstd")

    # A word occurs once in a block's list, so no word is hot here.
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "block", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("count")
    )
    counts = stored(
        listed.where("count > 0").groupBy("word").agg(F.sum("count").alias("count")), "hmm-counts", compression="zstd"
    )

    def classed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"class": class_of(batch.column("word"), settings), "count": batch.column("count")}
            )

    # At most one row per class comes to the driver here and after each pass.
    sizes = (
        counts.mapInArrow(classed, "class int, count long")
        .groupBy("class")
        .agg(F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("distinct"))
        .toPandas()
    )
    table = np.zeros((settings.classes, 2))
    table[sizes["class"].to_numpy(int)] = sizes[["tokens", "distinct"]].to_numpy(float)
    model = first_model(table, settings)

    columns = [f"e{k}" for k in range(settings.states)]
    wanted = blocks.select("held_out", "lengths", "codes", "classes")
    for _ in range(settings.iterations):
        found = (
            wanted.mapInArrow(count_rows(model), "class int, " + ", ".join(f"{c} double" for c in columns))
            .groupBy("class")
            .agg(*(F.sum(c).alias(c) for c in columns))
            .toPandas()
        )
        sums = dict(zip(found["class"].tolist(), found[columns].to_numpy()))
        model = next_model(model, sums, settings)

    known = listed.select("block", "at", "word").join(counts, "word").select(F.col("block").alias("of"), "at", "count")
    result = (
        blocks.select("block", "keys", "held_out", "lengths", "codes", "classes")
        .groupBy("block")
        .cogroup(known.groupBy("of"))
        .applyInArrow(
            score_rows(model),
            T.StructType(
                [
                    T.StructField("key", kind),
                    T.StructField("held_out", T.BooleanType()),
                    T.StructField("n_tokens", T.LongType()),
                    T.StructField("n_known", T.LongType()),
                    T.StructField("train_tokens", T.LongType()),
                    T.StructField("base_score", T.DoubleType()),
                    T.StructField("score", T.DoubleType()),
                ]
            ),
        )
    )
    return result.withColumnRenamed("key", key)
