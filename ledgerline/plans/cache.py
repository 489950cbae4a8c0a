"""Results kept for a time: as long as they are young and what they were made from is unchanged."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import exists, fresh_path

HOUR = 3600.0


def version_of(spark: SparkSession, sources: Sequence[str]) -> str:
    """Digest of the names, sizes and times of all files of ``sources`` (files or folders); no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(sources))
    digest = F.xxhash64("path", "length", F.col("modificationTime").cast("long"))
    row = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor(digest).alias("digest")).first()
    return f"{row['files']}-{row['bytes']}-{row['digest']}"


@dataclass(frozen=True)
class Entry:
    path: str
    schema: T.StructType
    version: str
    created: float


class ResultCache:
    """Stored results by key, in the shared folder, so that any executor can be lost.

    ``seconds`` is how long a result lives; ``clock`` tells the time.
    """

    def __init__(self, spark: SparkSession, seconds: float = HOUR, clock: Callable[[], float] = time.time) -> None:
        self.spark, self.seconds, self.clock = spark, seconds, clock
        self.entries: dict[str, Entry] = {}
        self.made = 0

    def valid(self, key: str, version: str) -> bool:
        entry = self.entries.get(key)
        young = entry is not None and entry.version == version and self.clock() - entry.created < self.seconds
        return young and exists(self.spark, entry.path)

    def get(self, key: str, sources: Sequence[str], compute: Callable[[], DataFrame]) -> DataFrame:
        """The stored result of ``key``, made again if it is too old, its sources changed, or its files are gone."""
        version = version_of(self.spark, sources)
        if self.valid(key, version):
            entry = self.entries[key]
            return self.spark.read.schema(entry.schema).parquet(entry.path)
        frame = compute()
        path = fresh_path(self.spark, f"result-{key}")
        frame.write.parquet(path)
        self.entries[key] = Entry(path, frame.schema, version, self.clock())
        self.made += 1
        return self.spark.read.schema(frame.schema).parquet(path)

    def refresh(self, key: str | None = None) -> None:
        """Forget one result, or all, so that the next ``get`` makes them again."""
        if key is None:
            self.entries.clear()
        else:
            self.entries.pop(key, None)
