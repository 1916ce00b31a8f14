"""WARC archives compressed with a dictionary of their own.

An archive is a file of Zstandard frames: a skippable frame with the dictionary, built from the records of the same
archive, then each record in a frame of its own, so that any record can be read by itself. Payloads that occur again are
``revisit`` records without the payload.

Tasks make whole archives of bounded size and Spark's text writer stores each as a file: its commit protocol leaves one copy
of every archive if tasks run again, and any file system that Spark knows will do. The line separator of that writer is
an empty skippable frame, which decoders pass over.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.store import stored

LEAST = 100  # bytes of a payload that may be replaced by a reference
HOT = 1000  # a payload with this part of all rows or more is broadcast: so many payloads at most
ARCHIVE_BYTES = 32 << 20  # of records before compression, unless one record is longer
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Frame magics (little endian), the separator as text, and names and values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode("ascii")
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:x-page:"
RESPONSE, REVISIT = "response", "revisit"


def record_types(pages: DataFrame, key: str, url: str, html: str, least: int = LEAST) -> DataFrame:
    """``key``, ``url``, ``html`` (empty for null; null where it need not be stored), ``bytes``, ``digest``, ``kind`` and ``refers``.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest key (null last, then the smallest url, null
    first) is the response and the others revisit it; of rows that are repeated whole one is the response. Smaller payloads
    are responses all.

    Payloads are compared by digest and counted first. Those that fill a thousandth of the table are broadcast, so their rows are not
    dealt by digest; rows of all others are, as long as there are any payloads that come twice.
    """
    rows = pages.select(
        F.col(key).alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    )
    payload = F.col("html").cast("binary")
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.unhex(F.sha2(payload, 256))})
    # Keys in order: null last.
    place = F.struct(F.col("key").isNull().alias("without"), "key", "url")
    each = rows.where(F.col("bytes") >= least).groupBy("digest", "key", "url").agg(F.count(F.lit(1)).alias("copies"))
    counted = each.groupBy("digest").agg(
        F.sum("copies").alias("uses"), F.min(F.struct(place.alias("place"), "copies")).alias("first")
    )
    counted = stored(counted.where(F.col("uses") > 1), "payloads")
    total = pages.count()
    common = F.col("uses") * HOT >= total
    hot, rest, tied = counted.agg(
        F.count_if(common), F.count_if(~common), F.coalesce(F.max("first.copies"), F.lit(0))
    ).first()
    known = counted.select("digest", F.col("first.place").alias("place"), F.col("first.copies").alias("copies"))
    joined = rows.withColumns({"place": F.lit(None).cast(known.schema["place"].dataType), "copies": F.lit(None).cast("long")})
    if hot:
        few = counted.where(common).select("digest", F.col("first.place").alias("p"), F.col("first.copies").alias("c"))
        joined = joined.join(F.broadcast(few), "digest", "left").withColumns({"place": F.col("p"), "copies": F.col("c")}).drop("p", "c")
    if rest:
        others = counted.where(~common).select(
            F.col("digest").alias("dealt"), F.col("first.place").alias("p"), F.col("first.copies").alias("c")
        )
        spread = F.when(F.col("copies").isNull(), F.col("digest")).otherwise(F.unhex(F.hex(F.xxhash64("key", "url"))))
        joined = joined.withColumn("dealt", spread).join(others.hint("shuffle_hash"), "dealt", "left")
        joined = joined.withColumns({"place": F.coalesce("place", "p"), "copies": F.coalesce("copies", "c")}).drop("p", "c", "dealt")
    first = F.col("key").eqNullSafe(F.col("place.key")) & F.col("url").eqNullSafe(F.col("place.url"))
    again = (F.col("bytes") >= least) & F.col("copies").isNotNull() & ~first
    decided = joined.select(
        "key",
        "url",
        F.when(~again, F.col("html")).alias("html"),
        "bytes",
        "digest",
        F.when(again, REVISIT).otherwise(RESPONSE).alias("kind"),
        F.when(again, F.col("place.key")).alias("refers"),
        (~again & (F.coalesce("copies", F.lit(1)) > 1)).alias("tied"),
    )
    if tied <= 1:
        return decided.drop("tied")
    same = decided.where("tied").groupBy("key", "url", "bytes", "digest")
    same = same.agg(F.count(F.lit(1)).alias("copies"), F.first("html").alias("html"))
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("number")
    same = same.select("key", "url", "html", "bytes", "digest", number)
    head = F.col("number") == 1
    same = same.select(
        "key",
        "url",
        F.when(head, F.col("html")).alias("html"),
        "bytes",
        "digest",
        F.when(head, RESPONSE).otherwise(REVISIT).alias("kind"),
        F.when(~head, F.col("key")).alias("refers"),
    )
    return decided.where(~F.col("tied")).drop("tied").unionByName(same)


def page_uri(key: str | None) -> str:
    """Record identifier of a page; a null key has an empty name, an empty one a blank."""
    return PAGE + ("" if key is None else quote(key or " ", safe=""))


def page_key(uri: str) -> str | None:
    name = unquote(uri.strip("<>").removeprefix(PAGE))
    return None if name == "" else "" if name == " " else name


def record(key, url, html, size: int, digest: str, kind: str, refers, date: str = DATE) -> bytes:
    """One record. The block of a revisit is the head of the answer, which holds the length of the payload that it leaves out.
    Control characters, which no address may hold, are written as percent codes."""
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = answer if kind == REVISIT else answer + html.encode()
    fields = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{page_uri(key)}>", f"WARC-Date: {date}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m.group()), url))
    if kind == REVISIT:
        fields += [f"WARC-Refers-To: <{page_uri(refers)}>", f"WARC-Profile: {PROFILE}"]
    fields += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    fields += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(fields).encode() + block + b"\r\n\r\n"


def archive(records: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES, level: int = LEVEL) -> bytes:
    """The records in frames of their own, after a dictionary built from all of them. Too few records for a dictionary (the
    library says so) go without one."""
    parts, trained = [], None
    size = min(dictionary_bytes, sum(map(len, records)) // 16)
    try:
        trained = zstandard.train_dictionary(size, records, k=256, d=8) if size >= 512 else None
    except zstandard.ZstdError:
        pass
    if trained is not None:
        raw = trained.as_bytes()
        parts.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        trained.precompute_compress(level=level)
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
    parts += [packer.compress(x) for x in records]
    return b"".join(parts)


def unpacked(data: bytes) -> Iterator[bytes]:
    """Records of an archive. Skippable frames other than a leading dictionary are passed over."""
    view, at, packed = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic >> 4 == SKIPPABLE_MAGIC >> 4:
            if magic == DICTIONARY_MAGIC and at == 0:
                trained = zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size]))
                packed = zstandard.ZstdDecompressor(dict_data=trained)
            at += 8 + size
            continue
        frame, found = packed.decompressobj(), []
        while not frame.eof:
            if at == len(view):
                raise ValueError("the last record of the archive is cut off")
            piece = view[at : at + (16 << 10)]
            found.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(found)


def parsed(raw: bytes) -> dict:
    """Fields of one record. Raises for a record whose lengths or digest do not hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    size = int(fields["content-length"])
    if lines[0] != VERSION or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"not a record of the stated length: {lines[:3]}")
    answer, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)^content-length: *(\d+)\r?$", answer, re.MULTILINE)[1])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == RESPONSE and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload and digest differ: {lines[:3]}")
    return {
        "page": page_key(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "date": fields["warc-date"],
        "record_type": kind,
        "refers_to": page_key(fields["warc-refers-to"]) if kind == REVISIT else None,
        "payload_digest": digest,
        "payload_bytes": length,
        "payload": payload if kind == RESPONSE else None,
    }


def write_archives(
    pages: DataFrame,
    key: str,
    url: str,
    html: str,
    folder: str,
    archive_bytes: int = ARCHIVE_BYTES,
    least: int = LEAST,
    date: str = DATE,
) -> None:
    """One record for each row, in archives of about ``archive_bytes`` (before compression) under ``folder``, a new path. A null page
    is an empty one, a null url is left out, an empty table gives no archive. Other columns are not read. A task holds one
    archive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            names = ("key", "url", "html", "bytes", "digest", "kind", "refers")
            columns = [batch.column(c) for c in names]
            for i in range(len(batch)):
                one = record(*(c[i].as_py() for c in columns), date)
                if held and size + len(one) > archive_bytes:
                    yield pa.RecordBatch.from_pydict({"value": pa.array([archive(held)], pa.binary())})
                    held, size = [], 0
                held.append(one)
                size += len(one)
        if held:
            yield pa.RecordBatch.from_pydict({"value": pa.array([archive(held)], pa.binary())})

    rows = record_types(pages, key, url, html, least).withColumns(
        {
            "key": F.col("key").cast("string"),
            "refers": F.col("refers").cast("string"),
            "digest": F.lower(F.hex("digest")),
        }
    )
    files = rows.select("key", "url", "html", "bytes", "digest", "kind", "refers").mapInArrow(run, "value binary")
    # One archive is one row, and one row is one file.
    writer = files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1)
    writer.option("lineSep", SEPARATOR).option("compression", "none").text(folder)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all archives under ``folder``: ``page`` (the key as text), ``url``, ``date``, ``record_type``, ``refers_to``, ``payload_digest``,
    ``payload_bytes`` (of the full payload, for revisits too) and ``payload`` (null for revisits, or without ``payloads``).
    Lengths and digests are verified. A task holds the archives of one split of files, and one record unpacked."""
    layout = (
        "page string, url string, date string, record_type string, refers_to string, payload_digest string, "
        "payload_bytes long, payload binary"
    )
    kinds = pa.schema([(n, pa.string()) for n in ("page", "url", "date", "record_type", "refers_to", "payload_digest")])
    kinds = kinds.append(pa.field("payload_bytes", pa.int64())).append(pa.field("payload", pa.binary()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for raw in unpacked(content.as_py()):
                    one = parsed(raw)
                    if not payloads:
                        one["payload"] = None
                    held.append(one)
                    size += 1000 + len(one["payload"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, layout)
