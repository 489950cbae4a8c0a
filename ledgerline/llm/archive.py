"""WARC archives of pages: one gzip member a record, written by tasks and read back as a stream.

A record is an HTTP response; a page whose payload another record holds already
is a revisit of that record. The reader decompresses member by member with
bounded buffers, takes the block's length from Content-Length, and checks block
and payload digests. Files end at a record once they pass a size, so readers
share the work by files.

A null html is an empty payload. Payloads under ``smallest`` bytes are always
responses. A row without id refers, if an equal payload with an id is there,
but is never referred to. Repeated rows of the smallest id are all responses.
A payload of any size is streamed; only when payloads are asked for is one
record held at a time. Empty tables give no file and no row. Other columns are
not stored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote_to_bytes

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import fresh_path
from .common import arrow_map, fresh, slices, written

VERSION = b"WARC/1.1"
SMALLEST = 100
FILE_BYTES = 64 << 20
# Compressed bytes read at a time, and decompressed bytes taken at a time.
BLOCK = 1 << 20
# A header block longer than this is not a record.
HEADER = 1 << 20
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
DATE = "1970-01-01T00:00:00Z"


class Damaged(ValueError):
    """A record that breaks framing or fails a digest; ``resumable`` if the next one can still be found."""

    def __init__(self, message: str, resumable: bool = False) -> None:
        super().__init__(message)
        self.resumable = resumable


def _lines(first: bytes, fields: list[tuple[str, object]]) -> bytes:
    return first + b"\r\n" + b"".join(f"{name}: {value}\r\n".encode() for name, value in fields if value is not None) + b"\r\n"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None, digest: str | None = None) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header, whose Content-Length is that of the full payload."""
    digest = digest or hashlib.sha256(payload).hexdigest()
    http = _lines(b"HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    block = http if refers_to is not None else http + payload
    head = _lines(VERSION, [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{URN}{'' if page is None else page}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!\"#$&'()*+,-./:;<=>?@[]^_`{|}~\\")),
        ("WARC-Refers-To", None if refers_to is None else f"<{URN}{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ])
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


@dataclass
class Record:
    """What the archive says of a record, its digests checked; ``payload`` only if it was asked for."""

    offset: int
    kind: str
    page: int | None
    url: str | None
    refers_to: int | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


class Member:
    """The decompressed bytes of one gzip member, by pieces."""

    def __init__(self, source: Reader) -> None:
        self.source, self.engine, self.ready = source, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        """Decompress a little further; false at the member's end."""
        while not self.engine.eof:
            if not self.source.left:
                self.source.fill()
            try:
                piece = self.engine.decompress(self.source.left, BLOCK)
            except zlib.error as error:
                raise Damaged(f"gzip member broken: {error}") from error
            if self.engine.eof:
                self.source.left = self.engine.unused_data
            else:
                self.source.left = self.engine.unconsumed_tail
            if piece:
                self.ready += piece
                return True
        return False

    def until(self, mark: bytes, limit: int) -> bytes:
        """Bytes up to and with ``mark``."""
        looked = 0
        while (at := self.ready.find(mark, looked)) < 0:
            looked = max(0, len(self.ready) - len(mark) + 1)
            if len(self.ready) > limit or not self.more():
                raise Damaged("no end of header")
        taken = bytes(self.ready[: at + len(mark)])
        del self.ready[: at + len(mark)]
        return taken

    def exactly(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.ready and not self.more():
                raise Damaged(f"record ends {size} bytes early")
            piece = bytes(self.ready[:size])
            del self.ready[: len(piece)]
            size -= len(piece)
            yield piece

    def drain(self) -> None:
        while self.more():
            self.ready.clear()


def _fields(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def _size(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", value):
        raise Damaged(f"Content-Length is {value!r}")
    return int(value)


def _page(value: str | None) -> int | None:
    found = re.fullmatch(f"<{URN}(-?[0-9]+)>", value or "")
    return int(found[1]) if found else None


class Reader:
    """Records of one archive in order. ``damage``: "raise", or "report" to yield the error in a record's place."""

    def __init__(self, stream, payloads: bool = False, damage: str = "raise") -> None:
        self.stream, self.payloads, self.damage, self.left, self.taken = stream, payloads, damage, b"", 0

    def fill(self) -> None:
        self.left = self.stream.read(BLOCK)
        self.taken += len(self.left)
        if not self.left:
            raise Damaged("archive ends inside a record")

    def __iter__(self) -> Iterator[Record | Damaged]:
        while True:
            if not self.left:
                self.left = self.stream.read(BLOCK)
                self.taken += len(self.left)
                if not self.left:
                    return
            member, offset = Member(self), self.taken - len(self.left)
            try:
                yield self._record(member, offset)
            except Damaged as error:
                told = Damaged(f"record at byte {offset}: {error}", error.resumable)
                if self.damage == "raise":
                    raise told from error
                yield told
                try:
                    member.drain()
                except Damaged:
                    return

    def _record(self, member: Member, offset: int) -> Record:
        head = member.until(b"\r\n\r\n", HEADER)
        if not head.startswith(b"WARC/"):
            raise Damaged("no WARC header", True)
        fields = _fields(head)
        size, kind = _size(fields), fields.get("warc-type", "")
        http = member.until(b"\r\n\r\n", HEADER) if size else b""
        if len(http) > size:
            raise Damaged("HTTP header is longer than the block", True)
        block, payload, kept = hashlib.sha256(http), hashlib.sha256(), []
        for piece in member.exactly(size - len(http)):
            block.update(piece)
            payload.update(piece)
            if self.payloads:
                kept.append(piece)
        if b"".join(member.exactly(4)) != b"\r\n\r\n" or member.ready or member.more():
            raise Damaged("the block is not as long as Content-Length says", True)
        stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        if "sha256:" + block.hexdigest() != fields.get("warc-block-digest"):
            raise Damaged("block digest differs", True)
        if kind == "response" and stated != payload.hexdigest():
            raise Damaged("payload digest differs", True)
        full = _size(_fields(http))
        if kind == "response" and full != size - len(http):
            raise Damaged("payload length differs", True)
        url = fields.get("warc-target-uri")
        return Record(
            offset, kind, _page(fields.get("warc-record-id")), None if url is None else unquote_to_bytes(url).decode("utf-8", "replace"),
            _page(fields.get("warc-refers-to")), full, stated, b"".join(kept) if self.payloads and kind == "response" else None,
        )


def _decided(pages: DataFrame, id_column: str, smallest: int) -> DataFrame:
    """Pages with payload, its digest and, for revisits, the id they refer to.

    The smallest id of each digest is found on ids and digests alone. The join
    brings it to the pages: a digest that many pages share has one row on the
    other side, so Spark can split its pages over tasks.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    taken = [id_column, "url", "html"]
    digest, first = (fresh(name, taken) for name in ("digest", "first"))
    own = pages.select(F.col(f"`{id_column}`").cast("bigint").alias(id_column), "url", payload.alias("html"))
    own = own.withColumn(digest, F.sha2("html", 256))
    firsts = (
        own.where(F.octet_length("html") >= smallest)
        .groupBy(F.col(digest).alias(f"{digest}_"))
        .agg(F.min(id_column).alias(first), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    joined = own.join(firsts, F.col(digest) == F.col(f"{digest}_"), "left")
    refers = F.when(~F.col(first).eqNullSafe(F.col(id_column)), F.col(first))
    return joined.select(F.col(id_column).alias("page"), "url", "html", F.col(digest).alias("digest"), refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, id_column: str = "page_id", smallest: int = SMALLEST, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of all pages under ``folder``; returns their manifest (path, records, bytes).

    A repeated task writes files of other names; the manifest names those of the
    tasks that counted. ``folder`` must be one that Arrow's file systems reach
    from every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, records, size = None, "", 0, 0
        for batch in slices(batches, "html"):
            for page, url, html, digest, refers in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    uri, records, size = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    system, path = fs.FileSystem.from_uri(uri)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                member = record(page, url, html, refers, digest)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    yield listed(uri, records, size)
                    out = None
        if out:
            out.close()
            yield listed(uri, records, size)

    def listed(uri: str, records: int, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return written(arrow_map(_decided(pages, id_column, smallest), run, "path string, records bigint, bytes bigint"), "archives")


READ = (
    ("page", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("path", pa.string()), ("offset", pa.int64()), ("error", pa.string()),
)


def read(manifest: DataFrame, id_column: str = "page_id", payloads: bool = False, damage: str = "raise") -> DataFrame:
    """Every record of the listed archives, one file a task; a revisit's payload is null, see ``restore``.

    With ``damage="report"`` a damaged record gives a row with ``error`` instead
    of ending the job; after broken compression the rest of that file is lost.
    """
    files = manifest.select("path").repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                system, path = fs.FileSystem.from_uri(uri)
                with system.open_input_stream(path, compression=None) as stream:
                    rows: list[tuple] = []
                    held = 0
                    for r in Reader(stream, payloads, damage):
                        if isinstance(r, Damaged):
                            rows.append((None, None, None, None, None, None, None, uri, None, str(r)))
                        else:
                            rows.append((r.page, r.url, r.kind, r.refers_to, r.payload_bytes, r.payload_digest, r.payload, uri, r.offset, None))
                            held += len(r.payload or b"")
                        if len(rows) >= 2000 or held >= BLOCK:
                            yield made(rows)
                            rows, held = [], 0
                    if rows:
                        yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), READ)], [name for name, _ in READ])

    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    found = arrow_map(files, run, ", ".join(f"{name} {kinds[kind]}" for name, kind in READ))
    return found.withColumnRenamed("page", id_column)


def restore(records: DataFrame, id_column: str = "page_id") -> DataFrame:
    """Records read with payloads, revisits filled from the response they refer to (one of each id and digest)."""
    sources = records.where(F.col("record_type") == "response").groupBy(
        F.col(id_column).alias("_page"), F.col("payload_digest").alias("_digest")
    ).agg(F.first("payload").alias("_payload"))
    there = (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    filled = records.join(sources, there, "left").withColumn("payload", F.coalesce("payload", "_payload"))
    return filled.drop("_page", "_digest", "_payload")


def new_folder(pages: DataFrame) -> str:
    """An unused folder for archives beside the session's other shared tables."""
    return fresh_path(pages.sparkSession, "warc")
