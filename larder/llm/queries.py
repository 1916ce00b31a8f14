"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import importlib.util
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalogue.scratch import scratch_folder
from larder.llm import bpe, chat, digest, hmm, mixing, quality, runs, sharding, simhash, spelling, topk, toxicity, warc

# Where the files of the public tokenizers are. Queries have no other parameters than the data, hence here.
RANKS = "byte_bpe_50k.tiktoken"
SHARDS = [f"shard-{i}" for i in range(32)]
SLOTS = 4099
WEIGHTS = (3, 1, 2)


def rank_file(name: str = RANKS) -> str:
    """Path of an installed rank file; found without importing anything from it."""
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.join(os.path.dirname(spec.origin), name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key, of: int):
    """crc32 of the key's text modulo ``of``."""
    return F.crc32(key.cast("string").cast("binary")) % of


def op1_hmm_score(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", remainder(F.col("doc_id"), 10) == 0)
    return hmm.score_texts(docs, "doc_id", "text", "held_out")


def op2_shard_placement(spark, folder):
    return sharding.place(table(spark, folder, "documents").select("doc_id"), "doc_id", SHARDS, SLOTS)


def op3_source_mix(spark, folder):
    found = mixing.copies(table(spark, folder, "documents"), "doc_id", "text", "source", WEIGHTS, 1.5, 2.0)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_byte_bpe(spark, folder):
    return bpe.digest_texts(table(spark, folder, "documents"), "doc_id", "text", rank_file())


def op5_chat_format(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        says.alias("text"),
    )
    turns = turns.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    pieces = chat.format_turns(turns, "conv_id", "turn", "role", "parts")
    return chat.read_back(chat.assemble(pieces)).withColumnRenamed("conversation", "conv_id")


def op6_simhash_groups(spark, folder):
    return simhash.cluster(table(spark, folder, "documents"), "doc_id", "text", size=4, most=4)


def op7_quality_score(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = remainder(F.col("doc_id"), 5) == 0
    found = quality.score_quality(docs, labels, lambda key: remainder(key, 5) != 0)
    return found.select("doc_id", held.alias("held_out"), "score", quality.predicted("score").alias("predicted"))


def op8_top_inner_products(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), "vec_id", "embedding", lambda key: key % 20 == 0, 20, 64.0)


def op9_improbable_digest(spark, folder):
    docs = table(spark, folder, "documents")
    return digest.compare_neighbours(docs, "doc_id", "text", digest.rarity(docs, "text"))


def op10_toxicity_score(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = remainder(F.col("doc_id"), 3) == 1
    found = toxicity.score_toxicity(docs, labels, lambda key: remainder(key, 3) != 1)
    return found.select("doc_id", held.alias("held_out"), "score", toxicity.predicted("score").alias("predicted"))


def repeated_words(h: int, n: int) -> np.ndarray | None:
    """For a tenth of the hashes, all words from one place on are the next few of them again and again."""
    if h % 10:
        return None
    g = h // 10
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < begin, places, begin + (places - begin) % period)


def op11_periodic_runs(spark, folder):
    salt = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = runs.find_runs(table(spark, folder, "documents"), "doc_id", "text", salt, repeated_words)
    return runs.digests(found, "doc_id")


def op12_spelling_variants(spark, folder):
    return spelling.group_variants(table(spark, folder, "documents"), "doc_id", "text", every=199)


def op13_warc_archives(spark, folder):
    archives = f"{scratch_folder(spark)}-warc"
    warc.write_archives(table(spark, folder, "pages"), "page_id", "url", "html", archives)
    found = warc.read_archives(spark, archives, payloads=False)
    number = lambda c: F.col(c).cast("long").alias(c)
    found = found.withColumnRenamed("page", "page_id")
    return found.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hmm_score,
        op2_shard_placement,
        op3_source_mix,
        op4_byte_bpe,
        op5_chat_format,
        op6_simhash_groups,
        op7_quality_score,
        op8_top_inner_products,
        op9_improbable_digest,
        op10_toxicity_score,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_warc_archives,
    )
}
