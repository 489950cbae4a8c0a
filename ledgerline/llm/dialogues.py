"""Prefix trie of conversations, by collapsing whole sequences.

Equal conversations become one weighted sequence; a trie node is known by sums
of turn digests, so no list of turns is ever built. Sequences that are proper
prefixes of others fall out by an anti-join, what remains are the leaves, and
every figure of a node is an aggregate over the sequences that pass it.

Turns without ``conv_id`` belong to no conversation. A null role or text is
empty. Turns go by number, null first; equal numbers by digest. Repeated rows
are repeated turns. An empty table has no conversation and so no root. Other
columns are ignored. A conversation of any length is numbered and summed in
blocks of turns, so none has to fit into a task; its texts stay where read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, written

# Turns of a conversation that one task sorts or sums together (by number of turn, then by position).
BLOCK = 64
# Ids of an end list are joined in chunks of so many neighbouring numbers before one hash runs over the chunks.
CHUNK = 4096
# Words of 32 bits that tell prefixes apart; sums of so many of them never leave 64 bits.
PIECES = ("k1", "k2", "k3", "k4")
LOW = 0xFFFFFFFF


def number(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position from 1, digest, chars)`` for every turn: positions by two levels, block and place in it."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.floor(F.col("turn") / BLOCK).alias("block"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
    )
    sizes = turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    placed = turns.join(before, (F.col("conv_id") == F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block")))
    within = W.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return placed.select("conv_id", (F.col("before") + F.row_number().over(within)).alias("position"), "digest", "chars")


def rebuild(numbered: DataFrame, group: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their ``group``, and all their ids.

    Conversation c takes the first h = crc32(c) % (most + 1) turns of c - c % group, then its own after the first h.
    """
    conv = F.col("conv_id")
    members = numbered.select("conv_id").distinct().select(
        "conv_id", (conv - conv % group).alias("base"), (F.crc32(conv.cast("string").cast("binary")) % (most + 1)).alias("h")
    )
    heads = numbered.where((conv % group == 0) & (F.col("position") <= most)).select(
        F.col("conv_id").alias("base"), "position", "digest", "chars"
    )
    taken = members.join(heads, "base").where(F.col("position") <= F.col("h"))
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    shift = members.join(lengths, "base", "left").select(
        "conv_id", "h", (F.least("h", F.coalesce("there", F.lit(0))) - F.col("h")).alias("shift")
    )
    own = numbered.join(shift, "conv_id").where(F.col("position") > F.col("h"))
    turns = taken.select("conv_id", "position", "digest", "chars").unionByName(
        own.select("conv_id", (F.col("position") + F.col("shift")).alias("position"), "digest", "chars")
    )
    return turns, members.select("conv_id")


def _pieces() -> list[Column]:
    """Four 32-bit words of a turn at its position."""
    words = [F.xxhash64(F.lit(seed), F.col("position"), F.col("digest")) for seed in (1, 2)]
    halves = [part for word in words for part in (word.bitwiseAND(LOW), F.shiftrightunsigned(word, 32))]
    return [half.alias(name) for half, name in zip(halves, PIECES)]


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: depth, sums of pieces, characters so far and of its last turn."""
    pieced = turns.select("conv_id", "position", "chars", F.floor(F.col("position") / BLOCK).alias("block"), *_pieces())
    summed = (*PIECES, "chars")
    blocks = pieced.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in summed])
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in summed])
    within = W.partitionBy("conv_id", "block").orderBy("position")
    so_far = {c: F.col(f"_{c}") + F.sum(c).over(within) for c in summed}
    depth = F.col("position")
    return pieced.join(before, ["conv_id", "block"]).select(
        "conv_id",
        depth.alias("depth"),
        F.struct(depth.alias("depth"), *[so_far[c].alias(c) for c in PIECES]).alias("node"),
        F.struct((depth - 1).alias("depth"), *[(so_far[c] - F.col(c)).alias(c) for c in PIECES]).alias("parent"),
        so_far["chars"].alias("total"),
        (so_far["chars"] - F.col("chars")).alias("before"),
    )


def _root() -> Column:
    return F.struct(F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(c) for c in PIECES])


def sequences(walked: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members ``(conv_id, end)`` and distinct sequences ``(conv_id of the smallest, end, weight, total)``."""
    last = walked.groupBy("conv_id").agg(F.max(F.struct("depth", "node", "total")).alias("last"))
    ended = members.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last.node", _root()).alias("end"), F.coalesce("last.total", F.lit(0)).alias("total")
    )
    distinct = ended.groupBy("end").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("total").alias("total")
    )
    return ended.select("conv_id", "end"), distinct


def end_lists(ended: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the ascending ids that end at a node, hashed as they stream by, chunk after chunk."""
    chunks = ended.groupBy("end", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    keys = [F.col("end")[c].alias(c) for c in ("depth", *PIECES)]
    names = ["depth", *PIECES]
    ordered = chunks.select(*keys, "chunk", "ids").repartition(*names).sortWithinPartitions(*names, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, hashlib.sha256()
        for batch in batches:
            rows: list[tuple] = []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*names, "ids")]):
                if key != current:
                    if current:
                        rows.append((*current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield made(rows)
        yield made([(*current, digest.hexdigest())] if current else [])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.string())], [*names, "ends_sha256"])

    hashed = arrow_map(ordered, run, ", ".join(f"{c} bigint" for c in names) + ", ends_sha256 string")
    return hashed.select(F.struct(*names).alias("node"), "ends_sha256")


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes of the conversations' prefix trie.

    A sequence owns the nodes whose smallest member it is; on its path these
    are all from some depth on. So distinct text below a node is a sum over the
    sequences through it, of what each owns there, and no pair of a node and
    its ancestor is ever made.
    """
    walked = written(prefixes(turns), "prefixes")
    ended, found = sequences(walked, members)
    found = written(found, "sequences")
    tops = found.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), _root().alias("node"), _root().alias("parent"),
        F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("before"),
    )
    paths = walked.join(found.select("conv_id"), "conv_id", "left_semi").unionByName(tops)
    weighted = paths.withColumnRenamed("total", "so_far").join(found.select("conv_id", "end", "weight", "total"), "conv_id")
    inner = weighted.where(F.col("node") != F.col("end")).select(F.col("node").alias("end")).distinct()
    leaves = found.join(inner, "end", "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    owners = written(paths.groupBy("node").agg(F.min("conv_id").alias("owner"), F.first("before").alias("before")), "owners")
    owned = owners.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min(F.struct(F.col("node.depth").alias("depth"), "before")).alias("from")
    )
    sequence = (
        found.join(owned, "conv_id", "left")
        .join(leaves, "conv_id", "left")
        .select(
            "conv_id", "weight", "total", F.coalesce("leaf", F.lit(0)).alias("leaf"),
            F.col("end.depth").alias("length"),
            F.coalesce("from.depth", F.lit(2**62)).alias("owns"),
            F.coalesce(F.col("total") - F.col("from.before"), F.lit(0)).alias("unique"),
        )
    )
    through = paths.withColumnRenamed("total", "so_far").join(sequence, "conv_id")
    own, depth, rest = F.col("owns") <= F.col("depth"), F.col("depth"), F.col("total") - F.col("before")
    nodes = through.groupBy("node", "parent").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum(((F.col("owns") == depth + 1) | (own & (F.col("length") > depth))).cast("bigint")).alias("n_children"),
        F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"),
        F.sum(F.col("weight") * rest - F.when(own, rest).otherwise(F.col("unique"))).alias("saved_tokens"),
    )
    above = owners.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    return (
        nodes.join(above, "parent", "left")
        .join(end_lists(ended), "node", "left")
        .select(
            "conv_id",
            F.col("node.depth").alias("depth"),
            F.when(F.col("node.depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations rebuilt on the first of their hundred."""
    numbered = written(number(conversations), "turns")
    return trie(*rebuild(numbered))
