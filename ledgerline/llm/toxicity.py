"""Toxicity by compression distance: two zstandard dictionaries, one of toxic, one of ordinary text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, fresh, slices, texts_of

# Labelled rows of each class the model is fitted on, lowest hash of the id first, and their characters at most.
FIT_DOCUMENTS, FIT_CHARACTERS = 1500, 8192
DICTIONARY_BYTES = 1024
# Word starts of these lengths are candidates for what is typical of toxic text.
STARTS = range(4, 13)
# Windows a Python worker remembers the lengths of, before the older half is forgotten.
REMEMBERED = 400_000
# A window is one word and this, which both dictionaries end in: it costs both the same and makes a block worth compressing.
CARRIER = b" ~carrier~of~a~window~ "
# Lengths are told apart up to here.
LONGEST = 12
_BREAKS = re.compile(rb"[\x00-\x20!-/:-@\[-`{-\x7f]+")

Cell = tuple[int, int, int]


def windows(text: bytes) -> list[bytes]:
    """Lower-cased words (A-Z only) without ASCII punctuation."""
    return [w for w in _BREAKS.split(text.lower()) if w]


@dataclass
class Model:
    """Dictionaries, log-likelihood ratio of each cell of lengths, and the calibration of their mean."""

    toxic: bytes
    ordinary: bytes
    cells: dict[Cell, float] = field(default_factory=dict)
    slope: float = 1.0
    threshold: float = 0.0
    prior: float = 0.5


class Scorer:
    def __init__(self, model: Model) -> None:
        import zstandard as zstd

        def compressor(content: bytes):
            parameters = zstd.ZstdCompressionParameters.from_level(3, source_size=64, dict_size=len(content), min_match=4)
            return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(content + CARRIER, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=parameters).compress

        self.model = model
        self.toxic, self.ordinary = compressor(model.toxic), compressor(model.ordinary)
        self.empty = [len(c(b" " + CARRIER)) for c in (self.toxic, self.ordinary)]
        self.memory: dict[bytes, Cell] = {}
        self.older: dict[bytes, Cell] = {}

    def cell(self, word: bytes) -> Cell:
        """Length of the word and of its window under either dictionary, less an empty window."""
        found = self.memory.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                window = b" " + word + CARRIER
                a, b = len(self.toxic(window)) - self.empty[0], len(self.ordinary(window)) - self.empty[1]
                found = (min(len(word), LONGEST), min(a, LONGEST + 4), min(b, LONGEST + 4))
            if len(self.memory) >= REMEMBERED // 2:
                self.memory, self.older = {}, self.memory
            self.memory[word] = found
        return found

    def evidence(self, text: bytes) -> float:
        """Mean over the windows of the ratios that speak for toxicity; a short text counts as eight windows."""
        found = windows(text)
        ratios, cell = self.model.cells, self.cell
        return sum([ratios.get(cell(w), 0.0) for w in found]) / max(len(found), 8)

    def score(self, text: bytes) -> float:
        if not text.strip():
            return min(self.model.prior, 0.49)
        x = self.model.slope * (self.evidence(text) - self.model.threshold)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def labelled(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> list[tuple[bool, bytes]]:
    """(toxic, text) of at most FIT_DOCUMENTS rows a class whose crc32(id as text) mod 5 is not 0.

    Only ids travel to choose them; of the chosen, texts of up to
    FIT_CHARACTERS characters come to the driver. Of several labels for one id
    the largest counts; null labels and null texts are left out.
    """
    fit = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(5)) != 0
    marks = labels.select(id_column, "toxic").where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull() & fit).groupBy(id_column).agg(F.max("toxic").alias("toxic"))
    spread = F.xxhash64(id_column)
    chosen = None
    for value in (1, 0):
        some = marks.where(F.col("toxic") == value).orderBy(spread, id_column).limit(FIT_DOCUMENTS)
        chosen = some if chosen is None else chosen.union(some)
    texts = documents(docs.where(F.length("text") <= FIT_CHARACTERS), id_column, "text")
    rows = texts.join(F.broadcast(chosen), id_column).groupBy(id_column).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # 2 x FIT_DOCUMENTS rows
    return [(r.toxic == 1, bytes(r.text)) for r in rows.orderBy(id_column).collect()]


def typical_starts(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> dict[bytes, float]:
    """Word starts that surely occur in more toxic than ordinary documents, with the lower bound of the log ratio."""

    def spread(texts: list[list[bytes]]) -> Counter:
        return Counter(start for words in texts for start in {w[:n] for w in set(words) for n in STARTS if n <= len(w)})

    a, b = spread(toxic), spread(ordinary)
    bound = {
        start: math.log((n + 0.5) / (len(toxic) + 1)) - math.log((b[start] + 0.5) / (len(ordinary) + 1)) - 3 * math.sqrt(1 / (n + 0.5) + 1 / (b[start] + 0.5))
        for start, n in a.items()
        if n >= 4
    }
    return {start: value for start, value in bound.items() if value > 0.5}


def dictionary(samples: list[bytes]) -> bytes:
    import zstandard as zstd

    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()[-DICTIONARY_BYTES:]
    except zstd.ZstdError:  # too few samples to train on: they serve as they are
        return b" ".join(samples)[:DICTIONARY_BYTES]


def fit(rows: list[tuple[bool, bytes]]) -> Model:
    """Dictionaries, cells and calibration. Without both labels, a model that scores everything the same, below 0.5.

    Toxic text is mostly ordinary text, so the toxic dictionary is trained on
    its typical word starts and the ordinary one on ordinary documents without
    them. Cells are fitted on all rows; slope and threshold by logistic
    regression with equal weight on each row.
    """
    split = {kind: [windows(t) for mark, t in rows if mark == kind] for kind in (True, False)}
    toxic, ordinary = split[True], split[False]
    if not toxic or not ordinary:
        return Model(b"", b"", threshold=1.0, prior=0.0)
    starts = typical_starts(toxic, ordinary)

    def typical(word: bytes) -> bytes | None:
        found = [word[:n] for n in STARTS if n <= len(word) and word[:n] in starts]
        return max(found, key=lambda s: (starts[s], len(s))) if found else None

    marked = [b" ".join(s for s in map(typical, words) if s) for words in toxic]
    plain = [b" ".join(w for w in words if not typical(w)) for words in ordinary]
    model = Model(dictionary([m for m in marked if m]), dictionary([p for p in plain if p]), prior=len(toxic) / len(rows))
    scorer = Scorer(model)
    counts = {kind: Counter(c for words in split[kind] for c in map(scorer.cell, words)) for kind in split}
    total = {kind: max(1, sum(counts[kind].values())) for kind in split}
    for cell in counts[True]:
        ratio = math.log((counts[True][cell] + 2.5) / total[True]) - math.log((counts[False][cell] + 2.5) / total[False])
        if ratio > 0:
            model.cells[cell] = ratio
    calibrate(model, [(mark, scorer.evidence(text)) for mark, text in rows])
    return model


def calibrate(model: Model, scored: list[tuple[bool, float]]) -> None:
    """Threshold of fewest errors on the rows, and a slope that makes scores probabilities around it."""
    order = sorted(scored, key=lambda s: s[1])
    values = np.array([v for _, v in order])
    marks = np.array([m for m, _ in order])
    # errors if all from i on are called toxic
    errors = np.concatenate([[0], np.cumsum(marks)]) + np.concatenate([np.cumsum(~marks[::-1])[::-1], [0]])
    ties = np.concatenate([[True], values[1:] > values[:-1], [True]])
    errors = np.where(ties, errors, len(values) + 1)
    least = np.flatnonzero(errors == errors.min())
    i = int(least[len(least) // 2])
    low = values[i - 1] if i else values[0] - 1
    high = values[i] if i < len(values) else values[-1] + 1
    model.threshold = float((low + high) / 2)
    x = values - model.threshold
    best = (math.inf, 1.0)
    for slope in np.geomspace(0.1, 1000, 81):
        loss = float(np.logaddexp(0, np.where(marks, -slope * x, slope * x)).sum())
        best = min(best, (loss, float(slope)))
    model.slope = best[1]


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", keep: tuple[str, ...] = (), name: str = "toxicity") -> DataFrame:
    """id, ``keep`` columns and ``name``, the toxicity (0 to 1), of every row in one pass; null and empty texts get the prior, below 0.5."""
    kept = [c for c in dict.fromkeys((id_column, *keep))]
    source = documents(docs, *[c for c in kept if c != "text"], "text")
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields} | {"text": "string"}
    loaded: list[Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loaded:
            loaded.append(Scorer(model))
        for batch in slices(batches):
            scores = pa.array([loaded[0].score(t) for t in texts_of(batch)], pa.float64())
            columns = [batch.column(c).cast(pa.string()) if c == "text" else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, scores], [*kept, name])

    return arrow_map(source, run, ", ".join(f"`{c}` {types[c]}" for c in kept) + f", `{name}` double")


def remove_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", limit: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``limit`` or more, by a model fitted on their own labelled rows."""
    names = docs.columns
    name = fresh("toxicity", names)
    scored = score(docs, fit(labelled(docs, labels, id_column)), id_column, keep=tuple(names), name=name)
    return scored.where(F.col(name) < limit).select(*[f"`{c}`" for c in names])
