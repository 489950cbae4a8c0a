"""Order MinHash: fingerprints whose likeness follows edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import M1, M2, arrow_map, documents, mix, slices, texts_of

K = 8  # code points of a k-mer
TAKEN = 2  # k-mers a component is made of
COMPONENTS = 64
# Positions hashed for all components at a time: 64 x 2048 32-bit numbers stay in a core's cache.
CHUNK = 2048
# Text of one range of documents, which is one task.
RANGE_BYTES = 16 << 20
_MIN32 = np.uint32(0xFFFFFFFF)

_rng = np.random.default_rng(2048)
MULTIPLIERS = (_rng.integers(0, 2**31, COMPONENTS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
SHIFTS = _rng.integers(0, 2**32, COMPONENTS, dtype=np.uint32)[:, None]


def kmers(points: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of K code points; a shorter text is one run, an empty one none."""
    n = len(points)
    if n < K:
        whole = np.array([int.from_bytes(hashlib.blake2b(points.tobytes(), digest_size=8).digest(), "little")], np.uint64)
        return whole if n else whole[:0]
    run, size, weight = points.astype(np.uint64), 1, int(M1)
    while size < K:
        run = run[:-size] * np.uint64(weight) + run[size:]
        size, weight = 2 * size, weight * weight % 2**64
    return mix(run)


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How many times each k-mer occurred before its position."""
    n = len(hashes)
    bits = max(1, int(n - 1).bit_length())
    keyed = (hashes >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
    keyed.sort()
    place = (keyed & np.uint64((1 << bits) - 1)).astype(np.int64)
    heads = keyed >> np.uint64(bits)
    index = np.arange(n)
    first = np.where(np.concatenate([[True], heads[1:] != heads[:-1]]), index, 0)
    out = np.empty(n, np.int64)
    out[place] = index - np.maximum.accumulate(first)
    return out


def fingerprint(text: str) -> np.ndarray:
    """COMPONENTS 16-bit numbers; all 0 for an empty text, never 0 otherwise.

    For each component a random order of the (k-mer, occurrence) pairs is
    drawn, the TAKEN smallest are kept, and their k-mers are hashed in the
    order they have in the text.
    """
    hashes = kmers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
    n = len(hashes)
    if not n:
        return np.zeros(COMPONENTS, np.uint16)
    pairs = (mix(hashes + occurrences(hashes).astype(np.uint64) * M2) >> np.uint64(32)).astype(np.uint32)
    rows = np.arange(COMPONENTS)
    values = np.full((COMPONENTS, TAKEN), _MIN32)
    places = np.full((COMPONENTS, TAKEN), n, np.int64)
    for start in range(0, n, CHUNK):
        drawn = (pairs[None, start : start + CHUNK] ^ SHIFTS) * MULTIPLIERS
        for _ in range(min(TAKEN, drawn.shape[1])):
            at = drawn.argmin(axis=1)
            least = drawn[rows, at]
            drawn[rows, at] = _MIN32
            worst = values.argmax(axis=1)
            # an earlier position wins a tie, and any pair beats an empty place
            better = (least < values[rows, worst]) | ((places[rows, worst] == n) & (least <= values[rows, worst]))
            values[rows[better], worst[better]] = least[better]
            places[rows[better], worst[better]] = start + at[better]
    places.sort(axis=1)
    padded = np.concatenate([hashes, [np.uint64(1)]])
    joined = padded[places[:, 0]]
    for j in range(1, TAKEN):
        joined = mix(joined * M1 + padded[places[:, j]])
    out = (mix(joined) >> np.uint64(48)).astype(np.uint16)
    out[out == 0] = 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def shown(print_: np.ndarray) -> str:
    return print_.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many of the first code points of the next text, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def borders(docs: DataFrame, id_column: str, parts: int) -> list[int]:
    """Ids that cut the table into about ``parts`` equal ranges; from a pass over ids alone."""
    shares = [i / parts for i in range(1, parts)]
    found = docs.select(F.percentile_approx(id_column, shares, max(10_000, 4 * parts)).alias("p")).first().p if shares else None
    return sorted(set(found or []))


def with_next(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next larger id (null ids first,
    repeated ids by text), after the last the first. Documents go to ranges of
    ids once; the document on which a range begins is also sent to the range
    before, and the first to the last range, so neighbours always meet. There
    are as many ranges as the texts fill of RANGE_BYTES, each a task of its own.
    A null text is empty. A single document is its own next. Integer ids.
    """
    known = docs.select(
        F.min(F.struct(F.col(id_column).isNotNull(), F.col(id_column))).alias("least"), F.sum(F.octet_length("text")).alias("bytes")
    ).first()
    cuts = np.array(borders(docs, id_column, max(1, -(-(known["bytes"] or 0) // RANGE_BYTES))), np.int64)
    first = None if known["least"] is None else known["least"][1]
    last_range = len(cuts)
    source = documents(docs, id_column, "text")
    kind = source.schema[id_column].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row in its range (rank 1), and as a neighbour (rank 2) where a range ends."""
        for batch in slices(batches):
            ids = batch.column(id_column)
            known = np.array([i if i is not None else np.iinfo(np.int64).min for i in ids.to_pylist()], np.int64)
            ranges = np.searchsorted(cuts, known, "right")
            begins = np.isin(known, cuts) & ids.is_valid().to_numpy(zero_copy_only=False)
            starts = (known == first) & ids.is_valid().to_numpy(zero_copy_only=False) if first is not None else ids.is_null().to_numpy(zero_copy_only=False)
            rows = np.concatenate([np.arange(len(known)), np.flatnonzero(begins), np.flatnonzero(starts)])
            where = np.concatenate([ranges, ranges[begins] - 1, np.full(starts.sum(), last_range)])
            rank = np.concatenate([np.ones(len(known)), np.full(begins.sum(), 2), np.full(starts.sum(), 2)])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(rank, pa.int32()), *taken.columns], ["_range", "_rank", id_column, "text"])

    dealt = arrow_map(source, deal, f"_range int, _rank int, `{id_column}` {kind}, text binary")
    ordered = dealt.repartitionById(last_range + 1, "_range").sortWithinPartitions("_range", "_rank", id_column, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, id, text, fingerprint) that waits for the next row
        for batch in slices(batches):
            out = []
            for place, rank, document, raw in zip(batch.column("_range").to_pylist(), batch.column("_rank").to_pylist(), batch.column(id_column).to_pylist(), texts_of(batch)):
                if held is None and rank == 2:
                    continue  # a further copy of the neighbour
                text = raw.decode("utf-8", "replace")
                print_ = fingerprint(text)
                if held is not None:
                    out.append(compared(held, text, print_))
                held = (document, text, print_) if rank == 1 else None
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.column(id_column).type), pa.array(columns[1], pa.int64()), *map(pa.array, columns[2:])],
                    [id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    def compared(held: tuple, text: str, print_: np.ndarray) -> tuple:
        document, own, mine = held
        changed = edited(own, text)
        other = fingerprint(changed)
        return document, len(own), hashlib.sha256(changed.encode()).hexdigest(), shown(mine), shown(other), likeness(mine, other), likeness(mine, print_)

    schema = f"`{id_column}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return arrow_map(ordered, run, schema)
