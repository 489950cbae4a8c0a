"""Packing by cutting-stock column generation: few, nearly full sequences from a length histogram."""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, documents, slices, texts_of, written
from .tokens import END, default_path, word_tokens

LENGTH = 2048
# Lengths are handled in classes of this many tokens: a piece takes at most UNIT - 1 more than it needs.
UNIT = 8
# Column generation ends when no pattern is worth this much more than a sequence: the plan is then as near its bound.
GAP = 5e-4
# Steps for each class in which the sum may stay as it is, before the plan is given up as stalled.
STALLED = 50
# Parts a length class is ranked in, so that no task ranks a whole class.
BUCKETS = 128

_PIECE = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: item k (1-based) weighs k; counts of the most valuable filling."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, int)  # best[capacity - room]: of that room
    for room in range(1, capacity + 1):
        offers = values[:room] + best[capacity - room + 1 :]
        k = int(offers.argmax())
        value, without = offers[k], best[capacity - room + 1]
        if value > without + 1e-12:
            best[capacity - room], choice[room] = value, k + 1
        else:
            best[capacity - room] = without
    counts, room = np.zeros(len(values), int), capacity
    while room > 0:
        if choice[room]:
            counts[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(best[0]), counts


def pivot(inverse: np.ndarray, direction: np.ndarray, row: int) -> None:
    """One elimination step in place; plain array work, as threaded matrix libraries stall beside a busy JVM."""
    inverse[row] /= direction[row]
    others = direction.copy()
    others[row] = 0
    inverse -= others[:, None] * inverse[row]


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with the largest pivot left in each column."""
    n = len(matrix)
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for k in range(n):
        best = k + int(np.abs(work[k:, k]).argmax())
        work[[k, best]] = work[[best, k]]
        pivot(work, work[:, k].copy(), k)
    return work[:, n:].copy()


def plan(demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(times, counts per class) that cover ``demand`` exactly; class k weighs k + 1 units, a pattern at most ``capacity``.

    The linear program min sum(x), sum(x * pattern) = demand starts from one
    pattern per class; the knapsack over the duals prices new ones. Whole parts
    of the solution are kept; what rounding leaves (fewer pieces than the basis
    holds) is filled best-fit, largest first.
    """
    used = np.flatnonzero(demand)
    left = demand.astype(np.int64).copy()
    chosen: list[tuple[int, np.ndarray]] = []
    if len(used):
        basis = np.zeros((len(used), len(used)))
        for i, k in enumerate(used):
            basis[i, i] = capacity // (k + 1)
        inverse = np.diag(1 / np.diag(basis))
        amounts = demand[used] / np.diag(basis)
        best, since = math.inf, 0
        for step in itertools.count():
            duals = inverse.sum(axis=0)
            values = np.zeros(len(demand))
            values[used] = np.maximum(duals, 0)
            worth, counts = best_pattern(values, capacity)
            if worth <= 1 + GAP:
                break
            # a pattern that is worth more makes the sum smaller, but for steps where a class is just used up
            total = float(amounts.sum())
            best, since = (total, step) if total < best - 1e-9 else (best, since)
            if step - since > STALLED * len(used):
                raise ArithmeticError(f"column generation stalls {worth - 1:.2g} over its gap")
            column = counts[used].astype(float)
            direction = (inverse * column).sum(axis=1)
            up = direction > 1e-9
            ratios = np.where(up, amounts / np.where(up, direction, 1), np.inf)
            leaving = int(np.argmin(ratios))
            amounts = np.maximum(amounts - ratios[leaving] * direction, 0)
            amounts[leaving] = ratios[leaving]
            basis[:, leaving] = column
            pivot(inverse, direction, leaving)
            if step % 200 == 199:  # start the inverse afresh: errors do not pile up
                inverse = inverted(basis)
                amounts = np.maximum((inverse * demand[used]).sum(axis=1), 0)
        for i in np.argsort(-amounts):
            counts = np.zeros(len(demand), np.int64)
            counts[used] = np.rint(basis[:, i]).astype(np.int64)
            held = counts > 0
            times = int(min(np.floor(amounts[i] + 1e-6), (left[held] // counts[held]).min()))
            if times > 0:
                chosen.append((times, counts))
                left -= times * counts
    while left.any():
        counts, room = np.zeros(len(demand), np.int64), capacity
        while room > 0:
            fitting = np.flatnonzero(left[:room] > counts[:room])
            if not len(fitting):
                break
            counts[fitting[-1]] += 1
            room -= fitting[-1] + 1
        held = counts > 0
        times = int((left[held] // counts[held]).min())
        chosen.append((times, counts))
        left -= times * counts
    return chosen


def pieces(docs: DataFrame, id_column: str = "doc_id", length: int = LENGTH, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """Every document's ids with the end id, cut into full pieces and a rest: start, length, ids_crc32, doc_tokens (and ids)."""
    path = tokenizer or default_path()
    source = documents(docs, id_column, "text")
    kind = source.schema[id_column].dataType.simpleString()
    fields = [*_PIECE, *([("ids", pa.list_(pa.int32()))] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_tokens(path).ids, END.to_bytes(4, "little")
        for batch in slices(batches):
            rows, owners = [], []
            for i, text in enumerate(texts_of(batch)):
                raw = encode(text) + end
                for start in range(0, len(raw) // 4, length):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((start, len(part) // 4, zlib.crc32(part), len(raw) // 4, np.frombuffer(part, "<i4") if ids else None))
                    owners.append(i)
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column).take(pa.array(owners)), *[pa.array(c, t) for c, (_, t) in zip(columns, fields)]],
                [id_column, *[n for n, _ in fields]],
            )

    schema = f"`{id_column}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids array<int>" if ids else "")
    return arrow_map(source, run, schema)


def pack(docs: DataFrame, id_column: str = "doc_id", length: int = LENGTH, unit: int = UNIT, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; each token is in one piece, offsets leave no gap.

    The driver sees the histogram (at most length / unit classes) and makes the
    patterns; pieces get their rank in their class, and rank decides pattern,
    copy and so sequence. A null or empty text has the end id alone; an empty
    table gives no rows; repeated rows are packed each.
    """
    spark, capacity = docs.sparkSession, length // unit
    cut = written(pieces(docs, id_column, length, tokenizer, ids), "pieces")
    spread = F.xxhash64(id_column, "start", "ids_crc32")
    keyed = cut.withColumn("_class", F.when(F.col("length") < length, F.ceil(F.col("length") / unit)).otherwise(capacity + 1).cast("int"))
    keyed = keyed.withColumn("_bucket", F.pmod(spread, F.lit(BUCKETS)).cast("int"))
    filled = written(keyed.groupBy("_class", "_bucket").count(), "lengths")  # classes x BUCKETS rows
    demand = np.zeros(capacity, np.int64)
    for row in filled.where(F.col("_class") <= capacity).groupBy("_class").agg(F.sum("count").alias("n")).collect():
        demand[row._class - 1] = row.n
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    first = 0
    taken = np.zeros(capacity, np.int64)
    for times, counts in plan(demand, capacity):
        for k in np.flatnonzero(counts):
            entries.setdefault(int(k) + 1, []).append((int(taken[k]), int(taken[k] + times * counts[k]), int(counts[k]), first))
            taken[k] += times * counts[k]
        first += times
    entries[capacity + 1] = [(0, 2**62, 1, first)]  # a full piece is a sequence of its own
    patterns = spark.createDataFrame(list(entries.items()), "_class int, _slots array<struct<low: bigint, high: bigint, each: bigint, first: bigint>>")
    before = filled.withColumn("_before", F.sum("count").over(W.partitionBy("_class").orderBy("_bucket")) - F.col("count")).drop("count")
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(W.partitionBy("_class", "_bucket").orderBy(spread, id_column, "start")))
        .join(F.broadcast(before), ["_class", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before") - 1)
        .join(F.broadcast(patterns), "_class")
        .withColumn("_slot", F.filter("_slots", lambda s: (s.low <= F.col("_rank")) & (F.col("_rank") < s.high))[0])
        .withColumn("sequence_id", (F.col("_slot.first") + F.floor((F.col("_rank") - F.col("_slot.low")) / F.col("_slot.each"))).cast("bigint"))
    )
    inside = W.partitionBy("sequence_id").orderBy(F.desc("length"), "_rank")
    placed = ranked.withColumn("offset", (F.sum("length").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("length")).cast("bigint"))
    return placed.select(*[f"`{c}`" for c in cut.columns], "sequence_id", "offset")


def sequences(packed: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """Token arrays of pieces packed with ids; filled up with ``pad`` except at a power of two."""
    joined = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    ids = joined.select("sequence_id", F.flatten("_parts.ids").alias("ids"))
    n = F.size("ids")
    full = F.bit_count(n) == 1
    return ids.select("sequence_id", F.when(full, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad), F.lit(length) - n))).alias("ids"))
