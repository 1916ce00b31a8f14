"""Corpus pipeline: toxic and poor documents go, near duplicates go, sources are mixed, texts are encoded.

Each stage takes the documents that the one before kept, as a table, and returns documents with the same columns; the last
one returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, mixing, quality, simhash, toxicity
from larder.llm.queries import WEIGHTS, rank_file, remainder
from larder.llm.store import stored


def toxic_gone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels, lambda key: remainder(key, 3) != 1, keep=True, score="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).drop("_toxicity")


def poor_gone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(docs, labels, lambda key: remainder(key, 5) != 0, keep=True, score="_quality")
    return scored.where(F.col("_quality") >= quality.THRESHOLD).drop("_quality")


def near_duplicates_gone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: four-word shingles, at most four differing bits."""
    return simhash.deduplicated(docs, "doc_id", "text", size=4, most=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs, "doc_id", "text", "source", weights=WEIGHTS, share=1.5, most=2.0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, digests of them and of the text decoded from them."""
    return bpe.digest_texts(docs, "doc_id", "text", rank_file())


STAGES = [
    ("toxicity", toxic_gone),
    ("quality classifier", poor_gone),
    ("SimHash near-dedup", near_duplicates_gone),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

# Learned scores and XXH64 fingerprints have no counterpart in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}", compression="zstd")
    return docs
