"""Token files: ids of each document in its own zstandard frame, under one shared dictionary.

A file holds frames, then its index (document ids, null flags, token counts,
frame offsets), then a fixed trailer with the dictionary's hash. Any document
can be read alone: two small reads for the index, one for its frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import fresh_path
from .common import arrow_map, documents, slices, texts_of, written
from .tokens import END, default_path, word_tokens

MAGIC = b"LLTOKZ01"
# index offset, documents, bytes of an id, dictionary hash, magic
TRAILER = struct.Struct("<QQB32s8s")

# The dictionary is fitted on this many documents of at most so many characters, lowest hash of the id first.
TRAINING_DOCUMENTS, TRAINING_CHARACTERS = 1000, 8192
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Text behind one file.
FILE_BYTES = 32 << 20
# Bytes of frames a reader fetches at a time.
BLOCK = 4 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def train(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", width: int = 2) -> bytes:
    """Dictionary content from a bounded sample of short documents; empty if there is nothing to learn from.

    Ids alone travel to choose the sample; then the texts of the chosen, one of
    each id, are picked up by a join with those few ids.
    """
    import zstandard as zstd

    short = docs.where(F.length("text") <= TRAINING_CHARACTERS)
    chosen = short.select(id_column).where(F.col(id_column).isNotNull()).distinct().orderBy(F.xxhash64(id_column), id_column).limit(TRAINING_DOCUMENTS)
    texts = documents(short, id_column, "text").join(F.broadcast(chosen), id_column)  # TRAINING_DOCUMENTS ids
    sample = texts.groupBy(id_column).agg(F.min("text").alias("text")).orderBy(F.xxhash64(id_column), id_column)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_tokens(tokenizer).ids
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([narrow(ids(t), width) for t in texts_of(batch)], pa.binary())], ["ids"])

    samples = [bytes(row.ids) for row in arrow_map(sample.select("text"), encoded, "ids binary").collect() if row.ids]
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstd.ZstdError:  # too little text to train on: its bytes serve as they are
        return b"".join(samples)[:DICTIONARY_BYTES]


def dictionary(content: bytes):
    import zstandard as zstd

    return zstd.ZstdCompressionDict(content) if len(content) >= 8 else None


def width_of(tokenizer: str) -> int:
    """Bytes that hold every id of a vocabulary."""
    from tokenizers import Tokenizer

    highest = max([END, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()])
    return 2 if highest < 1 << 16 else 4


def narrow(ids: bytes, width: int) -> bytes:
    """Little-endian 32-bit ids in ``width`` bytes each; raises ValueError if one does not fit."""
    if width == 4:
        return ids
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() >= 1 << 16:
        raise ValueError(f"id {wide.max()} does not fit {width} bytes")
    return wide.astype("<u2").tobytes()


class Writer:
    """Streams frames to one file; memory holds the index only."""

    def __init__(self, uri: str, content: bytes, width: int) -> None:
        import zstandard as zstd

        system, path = opened(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path)
        self.compress = zstd.ZstdCompressor(level=LEVEL, dict_data=dictionary(content), write_content_size=True).compress
        self.hash, self.width, self.at = hashlib.sha256(content).digest(), width, 0
        self.ids, self.nulls, self.counts, self.offsets = array("q"), bytearray(), array("Q"), array("Q", [0])

    def add(self, document: int | None, ids: bytes) -> None:
        frame = self.compress(narrow(ids, self.width))
        self.out.write(frame)
        self.at += len(frame)
        self.ids.append(document or 0)
        self.nulls.append(document is None)
        self.counts.append(len(ids) // 4)
        self.offsets.append(self.at)

    def close(self) -> int:
        for part in (self.ids, self.nulls, self.counts, self.offsets):
            self.out.write(bytes(part) if isinstance(part, bytearray) else part.tobytes())
        self.out.write(TRAILER.pack(self.at, len(self.ids), self.width, self.hash, MAGIC))
        self.out.close()
        return sum(self.counts)


class Reader:
    """One file: its index at once, its documents on demand."""

    def __init__(self, uri: str, content: bytes) -> None:
        import zstandard as zstd

        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        index, n, self.width, hashed, magic = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        if hashed != hashlib.sha256(content).digest():
            raise ValueError(f"{uri} needs another dictionary")
        raw = self.file.read_at(size - TRAILER.size - index, index)
        self.documents = np.frombuffer(raw, "<i8", n)
        self.nulls = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", n, 9 * n)
        self.offsets = np.frombuffer(raw, "<u8", n + 1, 17 * n).astype(np.int64)
        self.decompress = zstd.ZstdDecompressor(dict_data=dictionary(content)).decompress

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.decompress(frame), "<u2" if self.width == 2 else "<u4").astype("<u4")

    def read(self, i: int) -> np.ndarray:
        """Ids of the file's i-th document."""
        start, end = self.offsets[i], self.offsets[i + 1]
        return self._ids(self.file.read_at(int(end - start), int(start)))

    def __iter__(self) -> Iterator[np.ndarray]:
        first, n = 0, len(self.counts)
        while first < n:
            last = max(first + 1, int(np.searchsorted(self.offsets, self.offsets[first] + BLOCK, "right")) - 1)
            block = self.file.read_at(int(self.offsets[last] - self.offsets[first]), int(self.offsets[first]))
            for i in range(first, last):
                yield self._ids(block[self.offsets[i] - self.offsets[first] : self.offsets[i + 1] - self.offsets[first]])
            first = last


def write(docs: DataFrame, folder: str, id_column: str = "doc_id", tokenizer: str | None = None, width: int | None = None) -> tuple[DataFrame, bytes]:
    """Token files of all documents under ``folder`` and their manifest (part, path, documents, tokens).

    Documents are ordered by id over the files (null ids first, repeated ids by
    text), and there are as many files as the texts fill of FILE_BYTES; ``width`` is the bytes of an id, by default as many as the vocabulary needs. Every document ends with id 1; a
    null text has only that. A repeated task writes a file of another name,
    and the manifest names those of the tasks that counted. ``folder`` must be
    one that Arrow's file systems reach from every executor.
    """
    path = tokenizer or default_path()
    width = width or width_of(path)
    content = train(docs, path, id_column, width)
    size = docs.select(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    parts = max(1, -(-size // FILE_BYTES))
    ordered = documents(docs, id_column, "text").repartitionByRange(parts, id_column).sortWithinPartitions(id_column, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, writer, uri = word_tokens(path).ids, END.to_bytes(4, "little"), None, ""
        for batch in slices(batches):
            if writer is None:
                uri = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
                writer = Writer(uri, content, width)
            for document, text in zip(batch.column(id_column).to_pylist(), texts_of(batch)):
                writer.add(document, ids(text) + end)
        if writer:
            n, total = len(writer.ids), writer.close()
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "path": [uri], "documents": [n], "tokens": [total]},
                                             pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]))

    return written(arrow_map(ordered, run, "part int, path string, documents bigint, tokens bigint"), "manifest"), content


def read(manifest: DataFrame, content: bytes, id_column: str = "doc_id", ids: bool = False) -> DataFrame:
    """Documents of the files: id, start (ids before it in all files), n_tokens, ids_crc32 and, if asked, ids."""
    placed = manifest.withColumn("base", F.sum("tokens").over(W.orderBy("part")) - F.col("tokens"))  # one row per file
    spread = placed.select("path", "base").repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                reader = Reader(uri, content)
                starts = base + np.concatenate([[0], np.cumsum(reader.counts.astype(np.int64))])
                rows: list[tuple] = []
                for i, found in enumerate(reader):
                    if len(found) != reader.counts[i]:
                        raise ValueError(f"{uri}: document {i} is damaged")
                    rows.append((None if reader.nulls[i] else int(reader.documents[i]), int(starts[i]), len(found), zlib.crc32(found.tobytes()), found if ids else None))
                    if len(rows) >= 2000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
        names = [id_column, "start", "n_tokens", "ids_crc32"]
        if ids:
            arrays.append(pa.array(columns[4], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = f"`{id_column}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else "")
    return arrow_map(spread, run, schema)


def new_folder(docs: DataFrame) -> str:
    """An unused folder for files beside the session's other shared tables."""
    return fresh_path(docs.sparkSession, "tokens")
