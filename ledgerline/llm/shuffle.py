"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Source partitions; the matrix has PARTITIONS x shards numbers, however many rows there are.
PARTITIONS = 256

# Slices each shard is permuted in, so that no task holds a shard.
SLICES = 256


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` from good + bad, for counts of any size.

    Inversion over the probabilities within 40 standard deviations of the mode,
    from their ratios; what lies outside is far below one double's precision.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    deviation = np.sqrt(drawn * (good / total) * (bad / total) * max(total - drawn, 1) / max(total - 1, 1))
    reach = int(40 * deviation) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    # log of p(k+1) / p(k)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], "right"))


def communication_matrix(sources: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows each source sends to each shard, as a uniform permutation of all rows would: margins are exact."""
    rng = np.random.default_rng(seed)
    room, matrix = list(shards), []
    for rows in sources:
        line, left, rest = [], rows, sum(room)
        for shard, free in enumerate(room):
            sent = hypergeometric(rng, free, rest - free, left)
            line.append(sent)
            left, rest = left - sent, rest - free
            room[shard] = free - sent
        matrix.append(line)
    return matrix


def shuffle(rows: DataFrame, shards: int = 8, seed: int = 17, partitions: int = PARTITIONS, slices: int = SLICES) -> DataFrame:
    """All columns of ``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... in each shard).

    Shard sizes differ by at most one. Rows are dealt to source partitions and
    ordered there by seeded hashes of their content, so a lost executor's work
    comes out the same when repeated; equal rows are interchangeable. Nulls
    hash like any value; an empty table gives no rows; existing columns named
    shard or slot are replaced.
    """
    rows = rows.drop("shard", "slot")
    spark, names = rows.sparkSession, rows.columns
    content = [F.col(f"`{c}`") for c in names]

    def drawn(salt: int) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(salt), *content)

    dealt = rows.withColumn("_source", F.pmod(drawn(1), F.lit(partitions)).cast("int"))
    counts = {r._source: r["count"] for r in dealt.groupBy("_source").count().collect()}  # at most `partitions` rows
    total = sum(counts.values())
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    sources = sorted(counts)
    matrix = communication_matrix([counts[s] for s in sources], sizes, seed)
    limits = spark.createDataFrame(
        [(s, [int(x) for x in np.cumsum(line)]) for s, line in zip(sources, matrix)], "_source int, _limits array<bigint>"
    )
    # permute in the source, then send the first rows to shard 0, the next to shard 1, ...
    local = W.partitionBy("_source").orderBy(drawn(2), drawn(3))
    sent = (
        dealt.withColumn("_rank", F.row_number().over(local))
        .join(F.broadcast(limits), "_source")
        .withColumn("shard", F.size(F.filter("_limits", lambda limit: limit < F.col("_rank"))))
    )
    # permute again in the shard: a second key orders it, its leading bits name the slice
    sent = sent.withColumn("_key", drawn(4)).withColumn("_slice", F.pmod(F.shiftrightunsigned("_key", 32), F.lit(slices)).cast("int"))
    filled = sent.groupBy("shard", "_slice").agg(F.count("*").alias("_rows"))
    before = filled.withColumn("_before", F.sum("_rows").over(W.partitionBy("shard").orderBy("_slice")) - F.col("_rows"))
    inner = W.partitionBy("shard", "_slice").orderBy("_key", drawn(5))
    return (
        sent.withColumn("_place", F.row_number().over(inner))
        .join(F.broadcast(before.drop("_rows")), ["shard", "_slice"])  # shards x slices rows
        .select(*content, "shard", (F.col("_before") + F.col("_place") - 1).cast("bigint").alias("slot"))
    )
