"""Token counts of sections: documents are encoded once, tokens go to sections by their character spans."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, documents, slices, texts_of, vocabulary

BYTE_RANKS = "byte_bpe_50k.tiktoken"
_loaded: dict[str, tuple] = {}


def encoder(path: str) -> tuple:
    """The encoding and the bytes of each of its tokens, once for each worker process."""
    if path not in _loaded:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(ranks.values())] = [len(token) for token in ranks]
        _loaded[path] = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes
    return _loaded[path]


def token_spans(raw: bytes, path: str) -> np.ndarray:
    """Byte offsets of the token borders of a whole text: n + 1 of them. The encoding loses nothing, so lengths add up."""
    encoding, sizes = encoder(path)
    return np.concatenate([[0], np.cumsum(sizes[encoding.encode_ordinary(raw.decode())])])


def section_borders(raw: bytes) -> np.ndarray:
    """Byte offsets where sections begin, and the end: sections are lines with their line feed; an empty text has none."""
    if not raw:
        return np.zeros(1, np.int64)
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return np.unique(np.concatenate([[0], breaks, [len(raw)]]))


def allocate(tokens: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and how many of them cross one of its borders.

    A token belongs to the section with most of its bytes; of equals, to the
    first. So every token is counted once. Both lists of borders ascend: the
    join is a merge, and a token that spans several sections is looked at in each.
    """
    n, first = len(sections) - 1, tokens[:-1]
    last = tokens[1:]
    left = np.searchsorted(sections, first, "right") - 1
    right = np.searchsorted(sections, last, "left") - 1
    owner = left.copy()
    crossing = np.flatnonzero(right > left)
    for t in crossing:
        inside = np.minimum(sections[left[t] + 1 : right[t] + 2], last[t]) - np.maximum(sections[left[t] : right[t] + 1], first[t])
        owner[t] = left[t] + int(inside.argmax())
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def count(docs: DataFrame, id_column: str = "doc_id", ranks: str | None = None) -> DataFrame:
    """One row per section: id, section (from 0), start and end (characters), n_tokens, n_crossing, doc_tokens.

    Sections tile the text, and their n_tokens add up to doc_tokens. A null or
    empty text has one section of no characters and tokens. Repeated rows are
    counted each. One pass, no shuffle.
    """
    path = ranks or vocabulary(BYTE_RANKS)
    source = documents(docs, id_column, "text")
    kind = source.schema[id_column].dataType.simpleString()
    names = ["section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owners, columns = [], [[] for _ in names]
            for i, raw in enumerate(texts_of(batch)):
                if raw:
                    tokens, sections = token_spans(raw, path), section_borders(raw)
                    held, crossed = allocate(tokens, sections)
                    leading = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
                    points = np.concatenate([[0], np.cumsum(leading)])[sections]
                    rows = [np.arange(len(held)), points[:-1], points[1:], held, crossed, np.full(len(held), len(tokens) - 1)]
                else:
                    rows = [np.zeros(1, np.int64)] * len(names)
                owners.append(np.full(len(rows[0]), i))
                for column, values in zip(columns, rows):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column).take(pa.array(np.concatenate(owners))), *[pa.array(np.concatenate(c), pa.int64()) for c in columns]], [id_column, *names]
            )

    return arrow_map(source, run, f"`{id_column}` {kind}, " + ", ".join(f"{n} bigint" for n in names))
