"""Fitting and applying a subword classifier with Spark.

The model is fitted on the driver from a sample whose size is bounded by parameters, sent to the
tasks (its size is fixed by its settings), and every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import subwords
from larder.llm.store import stored
from larder.llm.words import merged

BLOCK_BYTES = 2 << 20
BIN_BITS = 16
LARGE = 64  # texts above this part of what a class may have come last


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample: ``rows`` labelled texts of each class, in the order of a hash of their
    key, and ``text_bytes`` bytes of text over all, half of them for a class. Texts above a 64th of that half come after all others, and one
    above the half is left out; a class that has labels and no text that fits is an error."""

    rows: int = 2500
    text_bytes: int = 32 << 20


def marked(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Rows (key, label 0/1). A key labelled several times has the majority's label, 1 at a tie; null labels and null keys
    say nothing."""
    return (
        labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"))
        .where("key is not null and label is not null")
        .groupBy("key")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn, bounds: Sample
) -> tuple[pa.Array, np.ndarray]:
    """The bounded sample on the driver, from documents whose key ``learn`` takes. Which rows are chosen depends on keys
    and texts alone; equal rows count once.

    No text is shuffled but those chosen: keys and hashes meet the labels, and the chosen keys, whose number is bounded,
    are sent to the texts.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where(learn(F.col("key")))
    marks, rank = marked(labels, key, label), F.xxhash64(F.lit(1), "key")
    share = bounds.text_bytes // 2
    # Ranks come in bins of equal width. Those up to the bin with the last wanted row of a class are enough, so that the
    # exact order below is made of few rows, however many are labelled.
    part = F.shiftrightunsigned(rank.bitwiseXOR(F.lit(-(1 << 63))), 64 - BIN_BITS)
    hashed = rows.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), F.xxhash64("text").alias("tie"))
    labelled = hashed.join(marks, "key").distinct().withColumns({"bin": part, "late": F.col("bytes") > share // LARGE})
    labelled = stored(labelled, "labelled")
    # Large texts stand behind all others, and one that is more than a class may have is left out.
    fitting = labelled.where(F.col("bytes") <= share)
    bins = fitting.groupBy("label", "late", "bin").agg(F.count(F.lit(1)).alias("count"))
    upto = Win.partitionBy("label").orderBy("late", "bin").rowsBetween(Win.unboundedPreceding, -1)
    last = (
        bins.withColumn("before", F.coalesce(F.sum("count").over(upto), F.lit(0)))
        .where(F.col("before") < bounds.rows)
        .groupBy("label")
        .agg(F.max(F.struct("late", "bin")).alias("last"))
    )
    # ``last`` has one row for each of the two classes.
    near = fitting.join(F.broadcast(last), "label").where(F.struct("late", "bin") <= F.col("last"))
    by_rank = Win.partitionBy("label").orderBy("late", "rank", "key", "tie")
    # A row number limit: every task sends on at most ``rows`` rows of a class. The windows by label see at most two bins of ranks for
    # each and ``rows`` rows of a class.
    first = near.withColumn("rank", rank).withColumn("n", F.row_number().over(by_rank)).where(F.col("n") <= bounds.rows)
    until = Win.partitionBy("label").orderBy("n").rowsBetween(Win.unboundedPreceding, 0)
    chosen = first.withColumn("sum", F.sum("bytes").over(until)).where(F.col("sum") <= share)
    # At most 2 * rows keys, and as many texts with at most ``text_bytes`` bytes.
    texts = (
        rows.withColumn("tie", F.xxhash64("text"))
        .join(F.broadcast(chosen.select("key", "tie", "label", "n")), ["key", "tie"])
        .dropDuplicates(["n", "label"])
        .select("label", "n", "text")
        .toArrow()
        .sort_by([("label", "ascending"), ("n", "ascending")])
    )
    classes = {row["label"] for row in labelled.select("label").distinct().collect()}
    if lost := classes - set(texts.column("label").to_pylist()):
        raise ValueError(f"no text of class {sorted(lost)} fits into the sample")
    found = texts.column("text").combine_chunks().fill_null("")
    return found, np.asarray(texts.column("label"), dtype=np.int64)


def apply(
    docs: DataFrame,
    key: str,
    text: str,
    model: subwords.Model,
    settings: subwords.Settings,
    keep: bool = False,
    score: str = "score",
) -> DataFrame:
    """Probability of class 1 for every row, as column ``score``, after ``key`` or, with ``keep``, after all columns.

    Every row gives one row, in place; a null or empty text has the score of the bias. With ``keep``, a
    column of ``docs`` named like ``score`` raises, so nothing is overwritten.
    """
    if keep and score.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {score} exists already")
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = dict(zip(docs.columns, rows.columns))
    names = rows.columns if keep else [at[key]]
    wanted = rows.select(*names, F.col(at[text]).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast((model.logits(), model.bias, model.kept))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logits, bias, kept = sent.value
        for rows in merged(batches, "text", BLOCK_BYTES):
            found = subwords.score(rows.column("text"), logits, bias, kept, settings)[:, 1]
            columns = [rows.column(c) for c in names] + [pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score"])

    schema = T.StructType([*(wanted.schema[c] for c in names), T.StructField("score", T.DoubleType())])
    return wanted.mapInArrow(run, schema).toDF(*(docs.columns if keep else [key]), score)

