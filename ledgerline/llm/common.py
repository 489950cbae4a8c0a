"""Helpers the operators share: rows, Arrow batches, word and shingle hashes, shared files."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import fresh_path

# Bytes of text a task turns into arrays at a time; a longer text is taken alone.
SLICE_BYTES = 1 << 20

U64 = np.uint64
M1, M2, GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, text as UTF-8 bytes (null stays null)."""
    return docs.select(*[F.col(f"`{c}`").cast("binary").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns])


def fresh(base: str, taken: list[str]) -> str:
    """``base``, with underscores before it until no column has its name (Spark compares them without case)."""
    names = {name.lower() for name in taken}
    while base.lower() in names:
        base = f"_{base}"
    return base


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(os.path.realpath(tempfile.mkdtemp(prefix="package-"))) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def arrow_map(frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow by executors that have this package."""
    ship(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Text bytes; null counts as empty."""
    return [value or b"" for value in batch.column(column).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, in place on a fresh array."""
    x = x ^ (x >> U64(30))
    x *= M1
    x ^= x >> U64(27)
    x *= M2
    x ^= x >> U64(31)
    return x


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table: true for bytes in any of the inclusive ranges."""
    kept = np.zeros(256, bool)
    for low, high in ranges:
        kept[low : high + 1] = True
    return kept


# [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, on UTF-8 bytes
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


class Words:
    """Words of several texts: byte spans, 64-bit hashes, and where each text's words begin.

    ``bounds[i]:bounds[i+1]`` are the words of text i. Spans index ``buffer``,
    the lower-cased texts joined by spaces; ``origin[i]`` is where text i begins.
    """

    def __init__(self, texts: list[bytes], kept: np.ndarray) -> None:
        self.buffer = b" ".join(texts).lower() + b" " * 9
        data = np.frombuffer(self.buffer, np.uint8)
        inside = kept[data]
        inside[-9:] = False
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.origin = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.bounds = np.concatenate([np.searchsorted(self.starts, self.origin), [len(self.starts)]])
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        longest = np.ndarray((len(self.buffer) - 7,), "<u8", self.buffer, strides=(1,))
        size = self.ends - self.starts
        hashes = mix(size.astype(np.uint64) * GOLDEN)
        rows, at, left = np.arange(len(size)), self.starts, size
        while len(rows):
            part = longest[at] & _KEEP[np.minimum(left, 8)]
            hashes[rows] = mix((hashes[rows] ^ part) * M2 + GOLDEN)
            more = left > 8
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
        return hashes

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of ``size`` words and where each text's begin; a shorter text is one run, an empty one none."""
        words = np.diff(self.bounds)
        counts = np.where(words >= size, words - size + 1, np.minimum(words, 1))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(bounds[-1], np.uint64)
        full = words >= size
        n = len(self.hashes)
        if full.any():
            runs = self.hashes[: n - size + 1] * M1
            for j in range(1, size):
                runs = (runs ^ (runs >> U64(29))) * M1 + self.hashes[j : n - size + 1 + j]
            runs = mix(runs + U64(size))
            where = np.repeat(self.bounds[:-1][full] - bounds[:-1][full], counts[full])
            rows = np.flatnonzero(np.repeat(full, counts))
            out[rows] = runs[rows + where]
        for i in np.flatnonzero(~full & (words > 0)):
            run = self.hashes[self.bounds[i] : self.bounds[i + 1]]
            whole = run[:1] * M1
            for j in range(1, len(run)):
                whole = (whole ^ (whole >> U64(29))) * M1 + run[j]
            out[bounds[i]] = mix(whole + U64(len(run)))[0]
        return out, bounds


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back: lineage ends there."""
    path = fresh_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; LEDGERLINE_TOKENIZERS names another folder."""
    folder = os.environ.get("LEDGERLINE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
