"""Archives read back against the rows that went in."""

import hashlib
import random
import struct

import compare
import pytest
import zstandard

from larder.catalogue.scratch import scratch_folder
from larder.llm import queries, warc
from larder.llm.oracle import ORACLE_SQL

LAYOUT = "page_id long, url string, html string, digest string, kind string, first long"


def sentence(r, words):
    return " ".join("".join(r.choices("ka lo mi ne pu ra so".split(), k=r.randint(1, 3))) for _ in range(words))


def plain(rows):
    """Type and reference by position in the order of key (null last), then url."""
    groups, found = {}, []
    for key, url, html in rows:
        groups.setdefault(html or "", []).append((key is None, key or 0, url is not None, url or "", key))
    for body, members in groups.items():
        raw = body.encode()
        for i, (*_, key) in enumerate(sorted(members, key=lambda m: m[:4])):
            again = i > 0 and len(raw) >= 100
            first = sorted(members, key=lambda m: m[:4])[0][4]
            found.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(found, key=repr)


def pages(seed=1, count=60):
    r = random.Random(seed)
    bodies = [f"<p>{sentence(r, r.randint(0, 200))}</p>" for _ in range(count)]
    rows = [(i, f"http://a.example/{i}", b) for i, b in enumerate(bodies)]
    rows += [(100 + i, f"http://b.example/{i}", r.choice(bodies[:20])) for i in range(60)]
    rows += [(200 + i, "http://c.example/", bodies[0] * 3) for i in range(40)]
    rows += [(5, "http://a.example/other", bodies[5]), (7, None, bodies[3]), rows[8], rows[8], (None, None, None)]
    rows += [(None, None, bodies[1]), (None, "http://null", bodies[0]), (300, None, ""), (301, "a\r\nb c", "é" * 50)]
    rows += [(302, "http://x", "é" * 50), (303, "http://x", "P*M\x18\x00\x00\x00\x00" * 40 + "WARC/1.1\r\n\r\n"), (304, "http://x", "x" * 300_000)]
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, "d", "k", 1) for row in rows], LAYOUT).repartition(4)


def archived(spark, df, **options):
    folder = f"{scratch_folder(spark)}-warc"
    warc.write_archives(df, "page_id", "url", "html", folder, **options)
    return folder


@pytest.mark.parametrize("hot, size", [(1000, 32 << 20), (3, 10_000), (1, 1)])
def test_rows_come_back(spark, monkeypatch, hot, size):
    """Payloads broadcast, some of them, and none but one; one archive a task to one a record."""
    monkeypatch.setattr(warc, "HOT", hot)
    rows = pages()
    folder = archived(spark, frame(spark, rows), archive_bytes=size)
    found = warc.read_archives(spark, folder).collect()
    number = lambda x: None if x is None else int(x)
    got = [(number(r.page), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found]
    assert sorted(got, key=repr) == plain(rows)
    bodies = {r.payload_digest: bytes(r.payload) for r in found if r.record_type == "response"}
    assert {b for b in bodies.values()} == {(h or "").encode() for _, _, h in rows}
    urls = {(number(r.page), r.url) for r in found}
    assert (301, "a%0D%0Ab%20c") in urls and (7, None) in urls


def test_archives_open_without_this_library(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", f"<html><body>{sentence(random.Random(i), 80)}</body></html>") for i in range(400)]
    folder = archived(spark, frame(spark, rows).coalesce(1))
    files = spark.read.format("binaryFile").load(folder).collect()
    assert len(files) == 1
    data = bytes(files[0].content)
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    trained = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert trained.dict_id() != 0
    reader = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(data, read_across_frames=True)
    text = reader.read()
    assert text.count(b"WARC/1.1\r\n") == 400
    plain_size = sum(len(zstandard.compress(x)) for x in warc.unpacked(data))
    assert len(data) - size < plain_size, "records gain from the dictionary"


def test_damage_is_seen():
    packed = warc.archive([warc.record("1", "u", "body", 4, hashlib.sha256(b"body").hexdigest(), "response", None)])
    assert warc.parsed(next(warc.unpacked(packed)))["payload"] == b"body"
    with pytest.raises(ValueError):
        list(warc.unpacked(packed[:-3]))
    with pytest.raises(ValueError):
        warc.parsed(warc.record("1", "u", "body", 4, "0" * 64, "response", None))


def test_keys_of_any_text():
    for key in (None, "", "a b", "5", "<>%/é\n"):
        assert warc.page_key(f"<{warc.page_uri(key)}>") == key


def test_no_pages(spark):
    folder = archived(spark, frame(spark, [(1, "u", "h")]).limit(0))
    assert warc.read_archives(spark, folder).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    sql = ORACLE_SQL["op13_warc_archives"]
    assert not compare.differences(queries.op13_warc_archives(spark, sf), compare.connect(sf), sql)
