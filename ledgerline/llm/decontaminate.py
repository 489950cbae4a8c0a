"""Benchmark decontamination with a generalised suffix automaton over item words."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows
from .automaton import AUTOMATON_BYTES, WINDOW, Automaton
from .common import ALNUM, GOLDEN, M1, U64, Words, arrow_map, documents, fresh, mix, slices, texts_of

# Bytes of benchmark text up to which its automata go to every worker; of a larger one, each group of items stays with its task.
SHIPPED_BYTES = 4 << 20


class _Neighbours:
    """Bit table of the word pairs (or single words) of the items, to skip text that cannot match."""

    def __init__(self, items: list[tuple[str, list[bytes]]], single: bool) -> None:
        self.single = single
        words = Words([b" ".join(w) for _, w in items], ALNUM)
        keys = words.hashes if single else self._pairs(words)
        self.mask = U64((1 << max(16, int(len(keys) * 64).bit_length())) - 1)
        self.table = np.zeros(int(self.mask) + 1, bool)
        self.table[keys & self.mask] = True

    @staticmethod
    def _pairs(words: Words) -> np.ndarray:
        return mix(words.hashes[:-1] * M1 + words.hashes[1:] * GOLDEN) if len(words.hashes) > 1 else np.zeros(0, np.uint64)

    def runs(self, words: Words, shortest: int) -> Iterator[tuple[int, int, int]]:
        """(text, first word, last word + 1) of stretches where every pair occurs in an item."""
        found = self.table[(words.hashes if self.single else self._pairs(words)) & self.mask]
        if not self.single:
            breaks = words.bounds[1:-1] - 1
            found[breaks[(breaks >= 0) & (breaks < len(found))]] = False
        padded = np.concatenate([[False], found, [False]])
        edges = np.flatnonzero(padded[1:] != padded[:-1])
        firsts, lasts = edges[0::2], edges[1::2] + (0 if self.single else 1)
        kept = lasts - firsts >= shortest
        firsts, lasts = firsts[kept], lasts[kept]
        texts = np.searchsorted(words.bounds, firsts, "right") - 1
        if self.single:  # a run of single words may reach over texts
            for text, first, last in zip(texts, firsts, lasts):
                while first < last:
                    end = min(last, words.bounds[text + 1])
                    if end > first:
                        yield text, first, end
                    first, text = end, text + 1
        else:
            yield from zip(texts, firsts, lasts)


def read_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list[list[tuple[str, list[bytes]]]]:
    """Items as word lists, in groups of at most AUTOMATON_BYTES (one item at least), read one partition at a time."""
    groups: list[list[tuple[str, list[bytes]]]] = []
    room = 0
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").cast("binary").alias("t"))
    for row in rows.where("t is not null").toLocalIterator():
        words = Words([bytes(row.t)], ALNUM)
        listed = [words.word(i) for i in range(len(words.hashes))]
        if not listed:
            continue
        if not groups or len(row.t) > room:
            groups.append([])
            room = AUTOMATON_BYTES
        room -= len(row.t)
        groups[-1].append((row.i or "", listed))
    return groups


_made: dict[str, list[tuple[Automaton, _Neighbours]]] = {}


def prepared(key: str, shared: list, window: int) -> list[tuple[Automaton, _Neighbours]]:
    """The automata of a scan, built once in each worker process and kept from task to task until another scan needs it."""
    if key not in _made:
        _made.clear()
        found = []
        for value in shared:
            automaton = Automaton(value.value, window)
            found.append((automaton, _Neighbours(value.value, automaton.shortest == 1)))
        _made[key] = found
    return _made[key]


# Hit words of each text of a batch (a flag a word, with one false before and after), and the items that hit it.
Hits = tuple[dict[int, np.ndarray], dict[int, set[str]]]


def _flags(hits: dict[int, np.ndarray], words: Words, text: int) -> np.ndarray:
    if text not in hits:
        hits[text] = np.zeros(words.bounds[text + 1] - words.bounds[text] + 2, bool)
    return hits[text]


def _by_shipped(source: DataFrame, benchmark: DataFrame, window: int) -> Callable[[pa.RecordBatch, Words], Hits]:
    shared = [source.sparkSession.sparkContext.broadcast(g) for g in read_items(benchmark)]  # SHIPPED_BYTES of text at most
    key = uuid.uuid4().hex

    def find(batch: pa.RecordBatch, words: Words) -> Hits:
        hits: dict[int, np.ndarray] = {}
        items: dict[int, set[str]] = defaultdict(set)
        for automaton, near in prepared(key, shared, window):
            for text, first, last in near.runs(words, automaton.shortest):
                for i, size, owners in automaton.stream([words.word(k) for k in range(first, last)]):
                    end = first + i + 1 - words.bounds[text]
                    _flags(hits, words, text)[end - size + 1 : end + 1] = True
                    items[text] |= owners
        return hits, items

    return find


def _by_windows(source: DataFrame, benchmark: DataFrame, size: int, window: int) -> tuple[DataFrame, Callable[[pa.RecordBatch, Words], Hits]]:
    digest, found = (fresh(name, source.columns) for name in ("digest", "found"))
    hits = windows.hits(source, benchmark, size, window).select(F.col("digest").alias(digest), F.struct("spans", "items").alias(found))

    def find(batch: pa.RecordBatch, words: Words) -> Hits:
        hits: dict[int, np.ndarray] = {}
        items: dict[int, set[str]] = {}
        for text, value in enumerate(batch.column(found).to_pylist()):
            if value:
                items[text] = set(value["items"])
                for span in value["spans"]:
                    _flags(hits, words, text)[span["start"] + 1 : span["end"] + 1] = True
        return hits, items

    return source.withColumn(digest, F.sha2("text", 256)).join(hits, digest, "left"), find


def scan(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", window: int = WINDOW, clean: bool = False,
         keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """Hits of every document against every item.

    Result: id, ``keep`` columns and, named with ``prefix``, n_words, n_hit, items (sorted array of ids as
    strings), spans (array of character [start, end) of the hit stretches) and,
    if ``clean``, ``cleaned``: the text without them. One row per input row, in
    one pass without a shuffle if the benchmark has up to SHIPPED_BYTES of text;
    its automata then go to every worker. Of a larger benchmark neither driver
    nor worker holds more than a group: see ``windows``. A null or empty text
    has no words; an item of fewer than ``window`` words is one window; items
    without words, and an empty benchmark, hit nothing; repeated items count
    once by id.
    """
    kept = [c for c in dict.fromkeys((id_column, *keep)) if c != "text"]
    source = documents(docs, *kept, "text")
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= SHIPPED_BYTES:
        find = _by_shipped(source, benchmark, window)
    else:
        source, find = _by_windows(source, benchmark, size, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch)
            words = Words(texts, ALNUM)
            hits, items = find(batch, words)
            counts, named, spans, cleaned = [], [], [], []
            for text, raw in enumerate(texts):
                hit = hits.get(text)
                if hit is None:
                    counts.append(0), named.append([]), spans.append([]), cleaned.append(raw)
                    continue
                edges = np.flatnonzero(hit[1:] != hit[:-1])
                base, origin = words.bounds[text], words.origin[text]
                cuts = [(int(words.starts[base + a] - origin), int(words.ends[base + b - 1] - origin)) for a, b in zip(edges[0::2], edges[1::2])]
                counts.append(int(hit.sum()))
                named.append(sorted(items[text]))
                spans.append([{"start": len(raw[:a].decode()), "end": len(raw[:b].decode())} for a, b in cuts])
                cleaned.append(without(raw, cuts) if clean else raw)
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(np.diff(words.bounds), pa.int64()), pa.array(counts, pa.int64()), pa.array(named, pa.list_(pa.string())),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            names = [*kept, *[prefix + n for n in ("n_words", "n_hit", "items", "spans")]]
            if clean:
                columns.append(pa.array([c if v is not None else None for c, v in zip(cleaned, batch.column("text").to_pylist())], pa.binary()).cast(pa.string()))
                names.append(prefix + "cleaned")
            yield pa.RecordBatch.from_arrays(columns, names)

    listed = ", ".join(f"`{c}` {types[c]}" for c in kept)
    found = "`{0}n_words` bigint, `{0}n_hit` bigint, `{0}items` array<string>, `{0}spans` array<struct<start: bigint, end: bigint>>"
    schema = f"{listed}, " + (found + (", `{0}cleaned` string" if clean else "")).format(prefix)
    return arrow_map(source, run, schema)


def without(raw: bytes, cuts: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in cuts:
        parts.append(raw[at:start])
        at = end
    return b"".join([*parts, raw[at:]])


def digest(values: Column) -> Column:
    return F.sha2(F.array_join(values, ",").cast("binary"), 256)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5) -> DataFrame:
    """Documents without the stretches they share with items; those hit in over ``max_coverage`` of their words go.

    Columns are those of ``docs`` (text and, if present, n_chars follow the
    cut). Documents without hits keep their text byte for byte.
    """
    names = docs.columns
    prefix = max(names, key=len) + "_"  # no column starts with a longer name
    n_words, n_hit, cleaned = (F.col(prefix + n) for n in ("n_words", "n_hit", "cleaned"))
    found = scan(docs, benchmark, keep=tuple(c for c in names if c != "text"), clean=True, prefix=prefix)
    left = found.where(n_hit <= n_words * F.lit(max_coverage)).withColumn("text", cleaned)
    if "n_chars" in names:
        left = left.withColumn("n_chars", F.when(n_hit > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*[f"`{c}`" for c in names])
