"""Session settings the jobs are tuned for; every one can be overridden."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # ingest stamps are UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small partitions, split skewed joins and writes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # a re-run replaces only the partitions it writes
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "ledgerline", master: str | None = None, **settings: str) -> SparkSession:
    """Session with SETTINGS plus ``settings`` (dots written as double underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Bytes of stored rows one task reads while tables are made (they are some thirty times as
# large where they are sorted or aggregated), and partitions it writes at a time without sorting by them.
SPLIT = 16 * 2**20
OPEN_FILES = 32

_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


def _bytes(size: str) -> int:
    digits = size.rstrip("bkmgtBKMGT")
    return int(digits) * _UNITS[size[len(digits):].lower()[:1]]


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks that hold what they sort, aggregate or write in memory, however large the tables are; for jobs run inside.

    A task is dealt up to 128 MB of a table by default, several gigabytes once
    read, so from some size on all rows are spilled. Smaller splits that were
    set already stay. Rows that were dealt out by the partition they are stored
    in are written to a few open files instead of being sorted by it first.
    """
    wanted = {
        "spark.sql.files.maxPartitionBytes": min(SPLIT, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))),
        "spark.sql.maxConcurrentOutputFileWriters": max(OPEN_FILES, int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
