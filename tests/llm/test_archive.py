"""WARC archives: exact round trips, revisits, framing and damage."""

import gzip
import hashlib
import io
import zlib

import pytest
from ledgerline.llm import archive
from pyspark.sql import functions as F

SCHEMA = "page_id bigint, url string, html string"


def stored(spark, tmp_path, rows, **options):
    return archive.write(spark.createDataFrame(rows, SCHEMA).repartition(3), f"file://{tmp_path}/warc", **options)


ROWS = [
    (0, "http://a.example/ä b?x=1%20", "short"), (1, None, None), (2, "http://b/", ""), (9, "http://c/\r\nInjected: yes", "x" * 100),
    (4, "http://c/2", "x" * 100), (7, "u", "x" * 99), (8, "u", "x" * 99), (5, "u", "é" * 50), (6, "u", "é" * 50),
    (11, "u", "a\r\n\r\nb" * 40), (12, "u", "line\x00\x1f\r\n" * 3000), (None, "n", "y" * 200), (13, "n", "y" * 200), (14, "n", "long " * 400_000),
]


def test_round_trip_and_revisits(spark, tmp_path):
    records = archive.read(stored(spark, tmp_path, ROWS), payloads=True).cache()
    rows = {r.page_id: r for r in records.collect()}
    assert len(rows) == len(ROWS) == records.count()
    smallest = {}
    for page, _, html in ROWS:
        if page is not None and len((html or "").encode()) >= 100:
            smallest[html] = min(page, smallest.get(html, page))
    for page, url, html in ROWS:
        r, payload = rows[page], (html or "").encode()
        refers = smallest.get(html)
        refers = None if refers == page else refers
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.record_type, r.refers_to) == ("response" if refers is None else "revisit", refers)
        assert r.url == url and (r.payload == payload if refers is None else r.payload is None)
    whole = {r.page_id: bytes(r.payload) for r in archive.restore(records).collect()}
    assert whole == {page: (html or "").encode() for page, _, html in ROWS}


def test_every_record_is_a_member_of_its_own(spark, tmp_path):
    manifest = stored(spark, tmp_path, ROWS, file_bytes=300)
    files = manifest.collect()
    assert len(files) > 3 and sum(f.records for f in files) == len(ROWS)
    for file in files:
        raw = open(file.path.removeprefix("file://"), "rb").read()
        assert file.bytes == len(raw) and gzip.decompress(raw).startswith(b"WARC/1.1\r\n")
        members = 0
        while raw:
            engine = zlib.decompressobj(31)
            text = engine.decompress(raw)
            head, block = text.split(b"\r\n\r\n", 1)
            assert engine.eof and f"Content-Length: {len(block) - 4}".encode() in head and block.endswith(b"\r\n\r\n")
            raw, members = engine.unused_data, members + 1
        assert members == file.records
    assert archive.read(manifest).count() == len(ROWS)


def test_repeated_rows_of_the_smallest_id_are_responses(spark, tmp_path):
    found = archive.read(stored(spark, tmp_path, [(3, "u", "z" * 100)] * 2 + [(4, "u", "z" * 100)] * 2)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to or -1) for r in found) == [(3, "response", -1)] * 2 + [(4, "revisit", 3)] * 2


def test_groups_without_ids_are_responses(spark, tmp_path):
    found = archive.read(stored(spark, tmp_path, [(None, "u", "z" * 100)] * 3)).collect()
    assert [(r.page_id, r.record_type) for r in found] == [(None, "response")] * 3


class Pieces(io.BytesIO):
    """Gives one byte more each time, whatever is asked."""

    def read(self, size=-1):
        return super().read(min(size, 7))


def test_reader_takes_any_pieces():
    content = [archive.record(i, f"http://x/{i}", bytes(range(256)) * i) for i in range(6)]
    for stream in (io.BytesIO, Pieces):
        found = list(archive.Reader(stream(b"".join(content)), payloads=True))
        assert [(r.page, r.payload) for r in found] == [(i, bytes(range(256)) * i) for i in range(6)]
    assert [r.offset for r in found] == [sum(map(len, content[:i])) for i in range(6)]


def member(text):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.flush()


def test_damage_is_found_and_reported():
    good = archive.record(1, "u", b"payload")
    text = gzip.decompress(good)
    broken = {
        "payload digest": archive.record(1, "u", b"payload", digest="0" * 64),
        "block digest": member(text.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n")),
        "early": member(text[:-8]),
        "Content-Length": member(text.replace(b"Content-Length: ", b"Content-Length: x")),
        "as long as": member(text + b"more"),
        "no WARC": member(text.replace(b"WARC/1.1", b"HTTP/1.1")),
        "no end of header": member(b"WARC/1.1\r\n"),
    }
    for message, bad in broken.items():
        with pytest.raises(archive.Damaged, match=message):
            list(archive.Reader(io.BytesIO(good + bad + good)))
        found = list(archive.Reader(io.BytesIO(good + bad + good), damage="report"))
        assert [isinstance(r, archive.Damaged) for r in found] == [False, True, False], message
    cut = list(archive.Reader(io.BytesIO(good + good[:-3]), damage="report"))
    assert [isinstance(r, archive.Damaged) for r in cut] == [False, True]
    torn = list(archive.Reader(io.BytesIO(good + good[:20] + b"\xff" * 40 + good), damage="report"))
    assert isinstance(torn[1], archive.Damaged) and len(torn) == 2


def test_damaged_files_are_rows_when_asked(spark, tmp_path):
    manifest = stored(spark, tmp_path, ROWS[:3], file_bytes=1)
    path = manifest.where("path is not null").orderBy("path").first().path.removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 255
    open(path, "wb").write(bytes(raw))
    found = archive.read(manifest, damage="report")
    assert found.where(F.col("error").isNotNull()).count() == 1 and found.where(F.col("error").isNull()).count() == 2


def test_clashing_extra_columns_and_no_rows(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 as digest", "2 as first", "3 as refers_to", "4 as n")
    manifest = archive.write(frame, f"file://{tmp_path}/extra")
    assert archive.read(manifest).count() == len(ROWS)
    none = archive.write(frame.limit(0), f"file://{tmp_path}/none")
    assert none.count() == 0 and archive.read(none).count() == 0
