"""Hits of a benchmark of any size: windows meet by hash, and each group of items is searched by its own automaton.

A bit table of all windows (FILTER_BYTES, whatever the benchmark) goes to every
task and picks the stretches of documents worth sending. Their windows are
joined with those of the items, which names the groups a stretch must visit.
A task reads a group's items, builds the automaton, and streams the group's
stretches by it. Nothing but the bit table passes the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import AUTOMATON_BYTES, Automaton
from .common import ALNUM, U64, Words, arrow_map, documents, slices, texts_of, written

# The bit table of windows; a power of two. A benchmark of more windows lets more stretches through, and loses none.
FILTER_BYTES = 8 << 20
# Windows of one stretch at most; a longer run is several stretches, each window in one of them.
STRETCH = 512
# Bytes of stretches one task streams by an automaton; a group with more has several tasks.
TASK_BYTES = 32 << 20


def grouped(benchmark: DataFrame, size: int) -> DataFrame:
    """group, item, text of the distinct items; a group has about half of AUTOMATON_BYTES."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    groups = math.ceil(2 * size / AUTOMATON_BYTES)
    return rows.where("text is not null").distinct().withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(groups)))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct (group, size, key): hashes of the windows of a group's items; an item of fewer words is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(texts_of(batch), ALNUM)
            keys, bounds = words.shingles(window)
            sizes = np.minimum(np.diff(words.bounds), window)
            columns = (np.repeat(column, np.diff(bounds)) for column in (batch.column("group").to_numpy(), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*columns, keys.view(np.int64))], ["group", "size", "key"])

    return arrow_map(items.select("group", "text"), run, "group bigint, size bigint, key bigint").distinct()


def bit_table(windows: DataFrame) -> np.ndarray:
    """One bit for each window's hash, modulo the table, in words of 64."""
    cells = windows.select(F.pmod("key", F.lit(FILTER_BYTES * 8)).alias("place")).groupBy(F.shiftright("place", 6).alias("cell"))
    rows = cells.agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).toArrow()  # FILTER_BYTES / 8 rows at most
    table = np.zeros(FILTER_BYTES // 8, np.int64)
    table[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint64)


def stretches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """digest, size, at (first word), keys, words: runs of windows of ``size`` words that the bit table knows, once for equal texts."""
    sizes = [r.size for r in windows.select("size").distinct().collect()]  # at most one for each number of words up to the window
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches):
            texts = texts_of(batch)
            words = Words(texts, ALNUM)
            rows: list[dict] = []
            digests: dict[int, str] = {}
            for size in sizes:
                keys, bounds = words.shingles(size)
                place = keys & U64(len(table) * 64 - 1)
                known = (table[place >> U64(6)] >> (place & U64(63)) & U64(1)).astype(bool)
                known &= np.repeat(np.diff(words.bounds) >= size, np.diff(bounds))
                found = np.flatnonzero(known)
                if not len(found):
                    continue
                text = np.searchsorted(bounds, found, "right") - 1
                at = found - bounds[text]
                new = (np.diff(text) != 0) | (np.diff(at) > size) | (np.diff(at // STRETCH) != 0)
                edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(found)]])
                for first, last in zip(edges[:-1], edges[1:]):
                    t = int(text[first])
                    if t not in digests:
                        digests[t] = hashlib.sha256(texts[t]).hexdigest()
                    base = words.bounds[t]
                    held = b" ".join(words.word(k) for k in range(base + at[first], base + at[last - 1] + size))
                    rows.append({"digest": digests[t], "size": size, "at": int(at[first]), "keys": keys[found[first:last]].view(np.int64), "words": held})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("digest", pa.string()), ("size", pa.int64()), ("at", pa.int64()), ("keys", pa.list_(pa.int64())), ("words", pa.binary())])
    found = arrow_map(documents(docs, "text"), run, "digest string, size bigint, at bigint, keys array<bigint>, words binary")
    return found.dropDuplicates(["digest", "size", "at"])


def hits(docs: DataFrame, benchmark: DataFrame, size: int, window: int) -> DataFrame:
    """digest (SHA-256 of a text, hex), spans (word [start, end) of hit stretches, they may overlap) and items, for every text with a hit.

    ``size`` is the benchmark's text in bytes. A group of items with many
    stretches is searched by several tasks, each with its own copy of the items.
    """
    items = written(grouped(benchmark, size), "items")
    windows = written(item_windows(items, window), "windows")
    found = written(stretches(docs, windows), "stretches")
    place = ["digest", "size", "at"]
    visits = found.select(*place, F.explode("keys").alias("key")).join(windows, ["size", "key"]).select(*place, "group").distinct()
    routed = written(found.drop("keys").join(visits, place), "routed")
    loads = routed.groupBy("group").agg(F.ceil(F.sum(F.length("words")) / TASK_BYTES).alias("tasks"))
    parts = items.join(loads, "group").select(
        "group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("bigint").alias("at"), F.col("item").alias("item"), F.col("text").alias("content"),
    )
    visitors = routed.join(loads, "group").select(
        "group", F.pmod(F.xxhash64(*place), F.col("tasks")).alias("task"), F.lit(1).alias("kind"), "digest", "at", F.lit(None).cast("string").alias("item"), F.col("words").alias("content")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading = built = None
        listed: list[tuple[str, list[bytes]]] = []
        automaton = Automaton([], window)
        for batch in batches:
            rows: list[dict] = []
            for row in batch.to_pylist():
                group = row["group"]
                if row["kind"] == 0:
                    if group != reading:
                        reading, listed = group, []
                    if group != built:
                        words = Words([row["content"]], ALNUM)
                        listed.append((row["item"], [words.word(i) for i in range(len(words.hashes))]))
                    continue
                if group != built:
                    automaton, built, listed = Automaton(listed, window), group, []
                spans: list[list[int]] = []
                owners: set[str] = set()
                for i, length, found in automaton.stream(row["content"].split(b" ")):
                    first, last = row["at"] + i + 1 - length, row["at"] + i + 1
                    if spans and first <= spans[-1][1]:
                        spans[-1][0], spans[-1][1] = min(first, spans[-1][0]), last
                    else:
                        spans.append([first, last])
                    owners |= found
                if spans:
                    rows.append({"digest": row["digest"], "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(owners)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("digest", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
    dealt = parts.unionByName(visitors).repartition("group", "task").sortWithinPartitions("group", "task", "kind")
    each = arrow_map(dealt, search, "digest string, spans array<struct<start: bigint, end: bigint>>, items array<string>")
    merged = each.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return written(merged, "hits")
