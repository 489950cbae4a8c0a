"""Spelling variants: words one edit apart, found by walking a trie that is a distributed edge table.

Words end with a mark and are stored forwards and backwards. A walk of a word
starts with its one edit behind it, in the later half of one of the two
directions, at a node its own prefix names. Each round joins the states (word,
position, node, one edit) with the edges by node and next character; below a
node with a single word the rest is compared at once. States that reach an end
are neighbours. A pair is found once: by replacing a character with a greater
one, or by deleting the last of a run of equal characters from the longer word.

Null and empty texts have no words; repeated documents count again; a null id
counts as an empty one. Words of equal count are chosen in code-point order.
Runs of any length are words: beyond ``SPAN`` code points a level a character
would be too many, so pairs with such a word meet by hashes of the word with
one character left out, linear in its length. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, written

RUN = r"[A-Za-zÀ-ÿ]+"
SHORTEST, FEWEST = 7, 2
# A word's form occurs so many times as often.
LIFT = 10
# Longest word that walks the trie; nodes nearer to the root than this are never reached by a word's later half.
SPAN, TOP = 40, SHORTEST // 2
# Forms have at least LIFT times the count of their words, and counts fit 64 bits: no chain is longer than 19, or 2**5 steps.
DOUBLINGS = 5
END = "\x00"


def lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(docs: DataFrame, id_column: str = "doc_id", every: int = 31) -> DataFrame:
    """``(word, n)`` of all runs of letters of at least SHORTEST code points and FEWEST occurrences.

    Of runs whose crc32 with the document's id is divisible by ``every`` one character is left out (0: of none).
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= SHORTEST)
    word = lower(F.col("run"))
    if every:
        h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
        runs = runs.withColumn("run", word)
        at = (h % F.length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        word = F.when(h % every == 0, cut).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= SHORTEST) & (F.col("n") >= FEWEST))


def _char(word: str, at: Column) -> Column:
    """The character at a position counted from 0."""
    return F.substring(F.col(word), at + 1, F.lit(1))


def _node(word: str, depth: Column) -> Column:
    """The node of a prefix of a turned word: a hash. Equal ones of different prefixes add candidates, never lose any."""
    return F.xxhash64("back", F.substring(F.col(word), F.lit(1), depth))


def _turned(vocabulary: DataFrame) -> DataFrame:
    """Both directions of every word, marked at the end."""
    both = vocabulary.select("word", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    return both.select("back", F.concat(F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")), F.lit(END)).alias("turned"))


def _edges(turned: DataFrame) -> DataFrame:
    """Edges ``(node, char) -> child`` below TOP.

    ``only`` is the word below a child that has no other; ``above`` and
    ``through`` are the node and character one level higher.
    """
    depth = F.col("depth")
    paths = turned.select("back", "turned", F.explode(F.sequence(F.lit(TOP), F.length("turned"))).alias("depth"))
    nodes = paths.groupBy(_node("turned", depth).alias("child")).agg(
        F.min(F.struct("turned", "depth", "back")).alias("a"), F.count(F.lit(1)).alias("below")
    )
    named = nodes.select("child", "below", "a.*")
    return named.where(depth > TOP).select(
        "child",
        F.when(F.col("below") == 1, F.col("turned")).alias("only"),
        _node("turned", depth - 1).alias("node"),
        _char("turned", depth - 1).alias("char"),
        F.when(depth > TOP + 1, _node("turned", depth - 2)).alias("above"),
        F.when(depth > TOP + 1, _char("turned", depth - 2)).alias("through"),
    )


def _started(turned: DataFrame, edges: DataFrame) -> DataFrame:
    """States just behind an edit and the character after it.

    Replacing goes two edges down from the word's node, by any greater
    character and then the word's own next one; deleting goes one edge down, by
    the next one. Both need that next character, so both are one join.
    """
    at = F.col("at")
    letters = F.length("turned") - 1
    half = F.when(F.col("back"), F.ceil(letters / 2)).otherwise(F.floor(letters / 2)).cast("int")
    places = turned.select("turned", "back", F.explode(F.sequence(half, letters - 1)).alias("at")).select(
        "turned", "back", "at", _node("turned", at).alias("from"), _char("turned", at).alias("own"), _char("turned", at + 1).alias("next"),
        # backwards, the last of a run is met first
        F.when(F.col("back"), _char("turned", at - 1) != _char("turned", at)).otherwise(_char("turned", at + 1) != _char("turned", at)).alias("last"),
    )
    replaced = edges.where(F.col("above").isNotNull()).select(F.col("above").alias("from"), F.col("char").alias("next"), F.col("through").alias("by"), "child", "only")
    deleted = edges.select(F.col("node").alias("from"), F.col("char").alias("next"), F.lit(None).cast("string").alias("by"), "child", "only")
    moved = places.join(replaced.unionByName(deleted), ["from", "next"])
    right = F.when(F.col("by").isNull(), F.col("last")).otherwise((F.col("by") > F.col("own")) & (F.col("by") != END))
    return _standing(moved.where(right).select(
        "turned", "back", (at + 2).alias("at"), F.col("child").alias("node"), "only", F.col("by").isNull().alias("shorter")
    ))


def _standing(states: DataFrame) -> DataFrame:
    """States that may still end, and those with one word left below them if that word is indeed a neighbour."""
    sizes = F.length("turned") - F.length("only") == F.col("shorter").cast("int")
    return states.where(F.col("only").isNull() | (sizes & (F.levenshtein("turned", "only", 1) == 1)))


def _ended(states: DataFrame) -> DataFrame:
    """Pairs of states that have come to their neighbour, turned back and without the mark."""
    bare = {c: F.substring(F.col(c), F.lit(1), F.length(c) - 1) for c in ("turned", "only")}
    straight = {c: F.when(F.col("back"), F.reverse(b)).otherwise(b) for c, b in bare.items()}
    return states.where(F.col("only").isNotNull()).select(straight["turned"].alias("word"), straight["only"].alias("other"))


def trie_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs one edit apart among words of at most SPAN code points, each pair once."""
    turned = _turned(vocabulary.select("word"))
    edges = written(_edges(turned), "edges")
    states = written(_started(turned, edges), "states")
    found = _ended(states)
    for _ in range(SPAN):
        living = states.where(F.col("only").isNull())
        if living.isEmpty():
            return found
        stepped = living.drop("only").withColumn("char", _char("turned", F.col("at"))).join(edges.select("node", "char", "child", "only"), ["node", "char"])
        states = written(_standing(stepped.select("turned", "back", (F.col("at") + 1).alias("at"), F.col("child").alias("node"), "only", "shorter")), "states")
        found = found.unionByName(_ended(states))
    return found


# Primes and bases of the hashes that long words meet by.
_FIELDS = ((2147483647, 1000003), (2147483629, 998244353), (2147483587, 16777619))


def _left_out(word: str) -> list[np.ndarray]:
    """For each character the hashes of the word without it; last, of the whole word."""
    codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    hashes = []
    for prime, base in _FIELDS:
        p, powers, step = np.uint64(prime), np.ones(1, np.uint64), base
        while len(powers) < len(codes):
            powers = np.concatenate([powers, powers * np.uint64(step) % p])
            step = step * step % prime
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[: len(codes)] % p, dtype=np.uint64)])
        after = (sums[-1] - sums[1:]) % p * np.uint64(pow(base, -1, prime)) % p
        hashes.append(np.append((sums[:-1] + after) % p, sums[-1] % p).astype(np.int64))
    return hashes


def long_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs one edit apart of which a word is longer than SPAN, each pair once.

    Words that differ in one character are equal without it, so they meet with
    its position; a longer word without a character meets the shorter one.
    Positions of one word and one shorter word are one pair.
    """
    near = vocabulary.where(F.length("word") >= SPAN).select("word", F.xxhash64("word").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, number in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist()):
                hashes = _left_out(word)
                size = len(word)
                for first in range(0, size + 1, 65536):
                    part = slice(first, min(size + 1, first + 65536))
                    at = np.arange(part.start, part.stop)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[part]) for h in hashes] + [pa.array(np.where(at < size, at, -1)), pa.array(np.full(len(at), size)), pa.array(np.full(len(at), number))],
                        ["h1", "h2", "h3", "at", "size", "id"],
                    )

    hashed = written(arrow_map(near, run, "h1 bigint, h2 bigint, h3 bigint, at bigint, size bigint, id bigint"), "left-out")
    keys = ["h1", "h2", "h3"]
    cut = hashed.where(F.col("at") >= 0)
    whole = hashed.where(F.col("at") < 0).select(*keys, F.col("size").alias("other_size"), F.col("id").alias("other_id"))
    shorter = cut.join(whole, keys).where(F.col("other_size") == F.col("size") - 1)
    mirror = cut.select(*keys, "at", "size", F.col("id").alias("other_id"))
    replaced = cut.join(mirror, [*keys, "at", "size"]).where(F.col("id") < F.col("other_id"))
    pairs = shorter.select("id", "other_id").unionByName(replaced.select("id", "other_id")).distinct()
    named = pairs.join(near.withColumnRenamed("word", "word_"), "id").join(near.select(F.col("word").alias("other"), F.col("id").alias("other_id")), "other_id")
    either = named.where((F.length("word_") > SPAN) | (F.length("other") > SPAN))
    return either.select(F.col("word_").alias("word"), "other")


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """All pairs ``(word, other)`` of the vocabulary that one inserted, deleted or replaced code point tells apart, both ways round."""
    short = trie_pairs(vocabulary.where(F.length("word") <= SPAN))
    pairs = short.unionByName(long_pairs(vocabulary))
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))


def forms(vocabulary: DataFrame) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of ``(word, n)``."""
    counts = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = (
        neighbours(vocabulary)
        .join(counts, "other")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    )
    # a neighbour too rare to be a form still counts as near
    often = -F.col("best.minus") >= LIFT * F.col("n")
    judged = written(
        vocabulary.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    steps = judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = written(steps.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return judged.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
