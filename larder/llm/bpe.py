"""Byte-level BPE with tiktoken and a local rank file.

A text is encoded as the library would encode it. Long texts are cut first where no match of the splitting
pattern can cross, so the library never sees a run that overflows its regular expression engine, and
the tokens stay the same.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The pattern that belongs to the rank files (fixed value, from the notes of the tokenizer files).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A cut may stand here: before white space that follows something else, after letters or after digits
# where something else follows. No match goes on beyond such a place, and none looks beyond it. After
# punctuation it may not stand: an apostrophe can belong to the letters behind it.
# White space is spelt out as the Unicode property: that is what the library's engine takes \s for, while
# Python's \s has four control characters more.
SPACE, OTHER = r"\p{White_Space}", r"\P{White_Space}"
SAFE = regex.compile(
    rf"(?<={OTHER})(?={SPACE})|(?<=\p{{L}})(?=[^\p{{L}}{SPACE}])|(?<=\p{{N}})(?=[^\p{{N}}{SPACE}])"
)

LONG = 1 << 16  # code points that go to the library at once
BLOCK_BYTES = 8 << 20


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """Encoding of a rank file, read once per Python worker. No special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def decimals(path: str) -> tuple[bytes, ...]:
    """Decimal text of each id."""
    return tuple(b"%d" % i for i in range(load(path).n_vocab))


def pieces(text: str, limit: int = LONG) -> Iterator[str]:
    """The text in parts that encode separately to the same tokens; a part is longer than ``limit`` only
    where there is no safe place."""
    start = 0
    while len(text) - start > limit:
        cut = None
        # The last safe place within the limit, looked for from the end in growing steps.
        reach = 256
        while cut is None and reach // 4 < limit:
            low = max(start + 1, start + limit - reach)
            for found in SAFE.finditer(text, low, start + limit):
                cut = found.start()
            reach *= 4
        if cut is None:
            found = SAFE.search(text, start + limit)
            cut = found.start() if found else len(text)
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


def encode(text: str, encoding: tiktoken.Encoding, limit: int = LONG) -> list[int]:
    if len(text) <= limit:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    splitter = regex.compile(encoding._pat_str.replace(r"\s", SPACE).replace(r"\S", OTHER))
    for part in pieces(text, limit):
        if len(part) <= limit:
            ids += encoding.encode_ordinary(part)
        else:
            # One long run. The pattern is matched here, and each match is merged by the library.
            for match in splitter.finditer(part):
                ids += encoding._encode_single_piece(match.group().encode())
    return ids


def token_rows(path: str, limit: int = LONG):
    """Map function: texts to ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from larder.llm.words import blocks

        encoding = load(path)
        for rows in blocks(batches, "text", BLOCK_BYTES):
            texts = rows.column("text").fill_null("").to_pylist()
            ids = pa.array([encode(text, encoding, limit) for text in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column("key"), ids], names=["key", "ids"])

    return run


def encode_texts(docs: DataFrame, key: str, text: str, path: str, limit: int = LONG) -> DataFrame:
    """``key`` and ``ids``, the tokens of the whole text. A null or empty text has none. One row per row:
    null and repeated keys are kept. Other columns are not read. ``path`` must exist on every executor."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(token_rows(path, limit), schema).withColumnRenamed("key", key)


def decode_ids(rows: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """``key`` and ``bytes``, the raw bytes of the ids; they need not be valid UTF-8. Null ids give none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path)
        for batch in batches:
            found = [encoding.decode_bytes(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary())], names=["key", "bytes"])

    rows = rows.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = T.StructType([rows.schema["key"], T.StructField("bytes", T.BinaryType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def digest_texts(docs: DataFrame, key: str, text: str, path: str, limit: int = LONG) -> DataFrame:
    """Encode and decode in one pass: ``key``, ``n_tokens``, ``ids_sha256`` (decimal ids, one space between) and
    ``decoded_sha256`` (bytes decoded from the ids). Same rows and null rules as ``encode_texts``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from larder.llm.words import blocks

        encoding, decimal = load(path), decimals(path)
        for rows in blocks(batches, "text", BLOCK_BYTES):
            counts, first, second = [], [], []
            for value in rows.column("text").fill_null("").to_pylist():
                ids = encode(value, encoding, limit)
                counts.append(len(ids))
                first.append(hashlib.sha256(b" ".join([decimal[i] for i in ids])).hexdigest())
                second.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), pa.array(counts, pa.int64()), pa.array(first), pa.array(second)],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            rows.schema["key"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
