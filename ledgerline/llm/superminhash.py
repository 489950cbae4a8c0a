"""SuperMinHash near-duplicates: banding, verification on full shingle sets, grouping."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import GOLDEN, SPACED, U64, Words, arrow_map, documents, fresh, mix, slices, texts_of, written

SHINGLE = 5
SIMILARITY = (80, 100)  # 100 * intersection >= 80 * union
# 25 bands of 4: a pair at 0.8 shares no band with probability 2e-6, one at 0.5 shares some with 0.8.
BANDS, ROWS = 25, 4
# Equal components (of 100) below which a pair is not verified; at 0.8 fewer occur with probability 1e-7.
LIKELY = 58
# Rows of a bucket compared with each other at once, and shingles of their texts; larger buckets are split into pairs of blocks.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000


class Settings(NamedTuple):
    shingle: int
    similarity: tuple[int, int]
    bands: int
    rows: int
    floor: int


def superminhash(shingles: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Signatures (texts x size, 16-bit) of the shingle sets ``shingles[bounds[i]:bounds[i+1]]``.

    Element d gives component p(j) the value j + r(j), where p is d's own random
    permutation, made by swaps as it goes, and j its step. A component keeps the
    smallest value. All elements of all texts take step j together; a text is
    done once its largest component is below j + 1, since later steps only give
    more. The result is a 16-bit hash of (j, r): unequal values agree once in 65,536. An empty set has a
    signature of no meaning.
    """
    texts = len(bounds) - 1
    best = np.full((texts, size), np.iinfo(np.uint64).max, np.uint64)
    flat = best.ravel()
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(texts), counts)
    live = shingles
    history: list[np.ndarray] = []
    for step in range(size):
        if not len(live):
            break
        drawn = mix(live + U64(int(GOLDEN) * (step + 1) & (2**64 - 1)))
        swap = (step + ((drawn & U64(0xFFFFFFFF)) * U64(size - step) >> U64(32)).astype(np.int64)).astype(np.int16)
        history.append(swap)
        place = swap.copy()
        for back in range(step - 1, -1, -1):  # what earlier swaps moved to this place
            place[history[back] == place] = back
        value = (U64(step) << U64(32)) | (drawn >> U64(32))
        np.minimum.at(flat, owner * size + place, value)
        done = best.max(axis=1) < (U64(step + 1) << U64(32))
        if done.any():
            stay = ~done[owner]
            live, owner = live[stay], owner[stay]
            history = [h[stay] for h in history]
    return (mix(best) >> U64(48)).astype(np.uint16)


def profiles(docs: DataFrame, id_column: str, shingle: int, size: int = BANDS * ROWS) -> DataFrame:
    """id, n_shingles, content (128-bit digest of the set) and signature; an empty set has null content."""
    source = documents(docs, id_column, "text")
    kind = source.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, bounds = distinct(texts_of(batch), shingle)
            signed = superminhash(sets, bounds, size)
            counts = np.diff(bounds)
            first = np.concatenate([[U64(0)], np.cumsum(mix(sets), dtype=np.uint64)])
            second = np.concatenate([[U64(0)], np.cumsum(mix(sets ^ GOLDEN), dtype=np.uint64)])
            sums = np.stack([first[bounds[1:]] - first[bounds[:-1]], second[bounds[1:]] - second[bounds[:-1]]], axis=1)
            full = counts > 0
            content = [sums[i].tobytes() if full[i] else None for i in range(len(counts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(counts, pa.int64()), pa.array(content, pa.binary()),
                 pa.array([s.tobytes() if f else None for s, f in zip(signed, full)], pa.binary())],
                [id_column, "n_shingles", "content", "signature"],
            )

    return arrow_map(source, run, f"`{id_column}` {kind}, n_shingles bigint, content binary, signature binary")


def distinct(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text and their bounds."""
    hashes, bounds = Words(texts, SPACED).shingles(shingle)
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return (np.concatenate(sets) if sets else hashes), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def texts_for(docs: DataFrame, wanted: DataFrame, id_column: str) -> DataFrame:
    """node and text of the documents whose id is a node of ``wanted``, one for each."""
    source = documents(docs, id_column, "text").select(F.col(id_column).cast("bigint").alias("node"), "text")
    return source.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity. Text travels, as it packs better than hashed sets."""
    left = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("_b")), "b")
    both = left.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_b"):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            needed = dict(zip(a, texts_of(batch, "_a"))) | dict(zip(b, texts_of(batch, "_b")))
            place = {node: i for i, node in enumerate(needed)}
            sets, bounds = distinct(list(needed.values()), shingle)
            kept = [i for i, pair in enumerate(zip(a, b)) if similar(*(sets[bounds[place[n]] : bounds[place[n] + 1]] for n in pair), similarity)]
            taken = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column("a"), taken.column("b")], ["a", "b"])

    return arrow_map(both.select("a", "b", "_a", "_b"), run, "a bigint, b bigint")


def buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(node, band, bucket, pivot, n, shingles) for every band of a class, where bucket has n > 1 nodes and pivot is the smallest."""
    width = 2 * rows
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * width + 1, F.lit(width))))
    spread = classes.select("node", "n_shingles", F.posexplode(keys).alias("band", "bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).where("n > 1")
    return spread.drop("n_shingles").join(shared, "bucket")


def pivots(spread: DataFrame, classes: DataFrame, floor: int) -> DataFrame:
    """Pairs of each node and the smallest node of its buckets, where the signatures allow the similarity."""
    pairs = spread.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    signed = classes.select("node", "signature")
    left = pairs.join(signed.select(F.col("node").alias("b"), F.col("signature").alias("_b")), "b")
    return alike(left.join(signed.select(F.col("node").alias("a"), F.col("signature").alias("_a")), "a").select("a", "b", "_a", "_b"), floor)


def alike(pairs: DataFrame, floor: int) -> DataFrame:
    """Pairs whose signatures (_a, _b) agree in ``floor`` components at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("_a", "_b"))
            kept = pa.array((a == b).sum(axis=1) >= floor)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    return arrow_map(pairs, run, "a bigint, b bigint")


def crossing(spread: DataFrame, classes: DataFrame, texts: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """Verified links between nodes that share a bucket but no component yet.

    A bucket is compared in blocks of BLOCK rows and BLOCK_SHINGLES shingles:
    block i meets block j >= i in one cell, so a task holds two blocks at most.
    A pair is looked at in the first band it shares. In a cell likely pairs are
    taken by likeness; once two components are joined there, their other pairs
    are settled. What leaves a cell is a forest of links, fewer than its rows.
    """
    members = spread.select("node", "bucket", "band", "n", "shingles").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = members.join(open_.select("bucket"), "bucket").withColumn("_blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    # block k takes part in the cells (k, k), (k, j > k) and (j < k, k)
    cells = members.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        F.xxhash64("bucket", F.least("block", "_with"), F.greatest("block", "_with")).alias("cell"),
        "band", "block", (F.col("block") == F.col("_with")).alias("own"), "node", "component",
    )
    held = cells.join(classes.select("node", "signature"), "node").join(texts, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("cell").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
            for first, last in zip(edges[:-1], edges[1:]):
                if values[first] != cell and parts:
                    yield from linked(pa.Table.from_batches(parts), settings)
                    parts = []
                cell = values[first]
                parts.append(batch.slice(first, last - first))
        if parts:
            yield from linked(pa.Table.from_batches(parts), settings)

    return arrow_map(held.repartition("cell").sortWithinPartitions("cell"), compare, "a bigint, b bigint").distinct()


def linked(cell: pa.Table, settings: Settings) -> Iterator[pa.RecordBatch]:
    nodes, components, blocks = (cell.column(c).to_numpy() for c in ("node", "component", "block"))
    band, own = cell.column("band")[0].as_py(), cell.column("own")[0].as_py()
    signed = np.frombuffer(b"".join(cell.column("signature").to_pylist()), "<u2").reshape(len(nodes), settings.bands, settings.rows)
    low, high, same = [], [], []
    for i in range(len(nodes) - 1):
        others = i + 1 + np.flatnonzero((components[i + 1 :] != components[i]) & ((blocks[i + 1 :] == blocks[i]) == own))
        equal = signed[others] == signed[i]
        count = equal.sum(axis=(1, 2))
        kept = (count >= settings.floor) & (equal.all(axis=2).argmax(axis=1) == band)
        low.append(np.full(kept.sum(), i)), high.append(others[kept]), same.append(count[kept])
    low, high, same = (np.concatenate(x or [[]]).astype(np.int64) for x in (low, high, same))
    if not len(low):
        return
    needed = np.unique(np.concatenate([low, high]))
    sets, bounds = distinct(cell.column("text").take(pa.array(needed)).to_pylist(), settings.shingle)
    place = np.searchsorted(needed, np.arange(len(nodes)))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    found = []
    for k in np.argsort(-same, kind="stable"):
        i, j = low[k], high[k]
        a, b = root(int(components[i])), root(int(components[j]))
        if a != b and similar(*(sets[bounds[place[x]] : bounds[place[x] + 1]] for x in (i, j)), settings.similarity):
            parent[max(a, b)] = min(a, b)
            found.append(sorted((int(nodes[i]), int(nodes[j]))))
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def similar(x: np.ndarray, y: np.ndarray, similarity: tuple[int, int]) -> bool:
    """Whether sorted sets reach the similarity; sizes too far apart are not compared."""
    least, whole = similarity
    if len(x) < len(y):
        x, y = y, x
    if whole * len(y) < least * len(x):
        return False
    common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return whole * common >= least * (len(x) + len(y) - common)


def labels(edges: DataFrame, label: str) -> DataFrame:
    """node and component (smallest node reachable) for the nodes of ``edges`` (a, b).

    Each task first replaces its edges by a forest (union-find). Then, until
    nothing changes: every node points at the smallest of its neighbours and
    itself (large star, small star). Rounds grow with the logarithm of the
    longest chain. Each round's edges are written to the shared folder.
    """
    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up] = parent.setdefault(up, up)
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        pairs = [(root(x), x) for x in list(parent)]
        pairs = [(a, b) for a, b in pairs if a != b]
        for first in range(0, len(pairs), 10_000):
            a, b = zip(*pairs[first : first + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    current = written(arrow_map(edges.select("a", "b"), forest, "a bigint, b bigint"), label)
    while True:
        # large star: neighbours above a node are tied to the smallest around it
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # small star: neighbours below a node, and the node, are tied to the smallest of them
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(small_least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        after = written(small, label)
        mixed = after.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        chained = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1)
        current = after
        if mixed.isEmpty() and chained.isEmpty():
            return current.select(F.col("b").alias("node"), F.col("a").alias("component"))


def components(docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
               bands: int = BANDS, rows: int = ROWS, floor: int = LIKELY) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links) for every document.

    Documents of equal sets are one class, linked to each other, and searched
    once. Links between classes come in two turns, verified on full sets: every
    class with the smallest of its buckets; then, between the components these
    links make, all remaining likely pairs of a bucket. So a group of near
    copies costs a few pairs a member, and no likely pair of different
    components goes unverified.
    Ids are 64-bit integers and stand for one document each (of several texts
    the smallest); a null id or an empty text is linked with nothing
    (component: its own id). Repeated rows are in one class. An empty table
    gives no rows.
    """
    profiled = written(profiles(docs, id_column, shingle, bands * rows), "profiles")
    classes = (
        profiled.where(F.col("content").isNotNull() & F.col(id_column).isNotNull())
        .groupBy("content")
        .agg(F.min(id_column).cast("bigint").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    classes = written(classes, "classes")
    spread = written(buckets(classes, bands, rows), "buckets")
    texts = written(texts_for(docs, spread.select("node").distinct(), id_column), "texts")
    links = written(verified(pivots(spread, classes, floor), texts, shingle, similarity), "links")
    found = labels(links, "labels")
    more = written(crossing(spread, classes, texts, found, Settings(shingle, similarity, bands, rows, floor)), "links")
    found = labels(links.union(more), "labels")
    named = classes.select("content", "node").join(found, "node", "left").select("content", F.coalesce("component", "node").alias("component_id"))
    return profiled.join(named, "content", "left").select(
        id_column, "n_shingles", F.coalesce("component_id", F.col(id_column)).alias("component_id")
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without all but the smallest id of each component.

    An id stands for one document: of rows that share it, the one of the
    smallest text stays. Rows of null id stay, as they have no component.
    """
    found = components(docs, id_column, **settings)
    kept = found.where(F.col(id_column) == F.col("component_id")).select(id_column).distinct()
    place = fresh("place", docs.columns)
    numbered = docs.join(kept, id_column, "left_semi").withColumn(place, F.row_number().over(W.partitionBy(id_column).orderBy("text")))
    return numbered.where(F.col(place) == 1).select(*[f"`{c}`" for c in docs.columns]).unionByName(docs.where(F.col(id_column).isNull()))
