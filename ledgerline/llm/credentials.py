"""Secret scans with corpus-wide ownership: widely copied examples against secrets of one owner."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, fresh, slices, texts_of, written

# Fixed patterns of the base kinds, in their order; group 1 is the value.
ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"(AKIA[A-Z0-9]{12,})")
HEX = re.compile(r"([0-9a-f]{32,})")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")
KINDS = ("assign", "access", "hex", "owned")
# The method's own candidates: long mixed runs that no base kind covers.
MIXED = re.compile(r"([A-Za-z0-9+/_=-]{20,})")
# Bits a character of a mixed run must carry at least.
ENTROPY = 3.5
# A value in documents of this many owners, or this many documents of one owner, is an example that is passed around.
COPIED_OWNERS, COPIED_DOCUMENTS = 3, 20

_HIT = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary())])


def entropy(value: str) -> float:
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts)


def covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that ``spans`` cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of all candidates, base kinds by their patterns, then mixed runs clear of them."""
    raw = text.lower().encode()
    found: list[tuple[str, int, int, str]] = []
    if any(word in raw for word in _KEYWORDS):
        found += [("assign", *m.span(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), m[1]) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), m[1]) for m in HEX.finditer(text)]
    starts, ends = covered([(a, b) for _, a, b, _ in found])
    for m in MIXED.finditer(text):
        value = m[1]
        if value.isalpha() or value.isdigit() or not re.search("[0-9]", value) or entropy(value) < ENTROPY:
            continue
        at = bisect_right(ends, m.start())
        if at == len(starts) or starts[at] >= m.end():
            found.append(("owned", *m.span(), value))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def row_key(id_column: str, owner: str) -> Column:
    """Digest of id, owner and text: equal rows share it, and so their spans."""
    head = F.to_json(F.struct(F.col(f"`{id_column}`").alias("i"), F.col(f"`{owner}`").alias("o"))).cast("binary")
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    return F.unhex(F.sha2(F.concat(head, text), 256)).alias("row")


def candidates(docs: DataFrame, id_column: str, owner: str) -> DataFrame:
    """One row per document: row (digest of id, owner and text), id, owner and hits (kind, start, end, hash of the value)."""
    source = documents(docs, id_column, owner, "text").select(row_key(id_column, owner), id_column, F.col(owner).cast("string").alias("_owner"), "text")
    kind = source.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hits = [
                [{"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).digest()[:16]} for k, a, b, v in find(raw.decode("utf-8", "replace"))]
                for raw in texts_of(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column(id_column), batch.column("_owner"), pa.array(hits, pa.list_(_HIT))], ["row", id_column, "_owner", "hits"]
            )

    return arrow_map(source, run, f"row binary, `{id_column}` {kind}, _owner string, hits array<struct<kind: string, start: bigint, end: bigint, value: binary>>")


def ownership(found: DataFrame) -> DataFrame:
    """value, documents, owners and live: whether few own it. Counted per owner first, so a value everyone has is a row per owner."""
    spread = found.select("row", "_owner", F.explode("hits").alias("hit")).select(F.col("hit.value").alias("value"), "_owner", "row").distinct()
    each = spread.groupBy("value", "_owner").agg(F.count("*").alias("n"))
    whole = each.groupBy("value").agg(F.sum("n").alias("documents"), F.count("*").alias("owners"))
    return whole.withColumn("live", (F.col("owners") < COPIED_OWNERS) & (F.col("documents") < COPIED_DOCUMENTS))


def scan(docs: DataFrame, id_column: str = "doc_id", owner: str = "source", rows: bool = False) -> DataFrame:
    """id, spans (kind, start, end, documents, owners, live; sorted by start, then kind) of every row.

    A document stands for its repository, its ``owner`` column for the owner
    (null owners count as one). A candidate's value is counted by distinct
    documents and owners over the whole corpus: ``live`` if few have it, else a
    copied example. Mixed runs that no base pattern covers are spans (kind
    ``owned``) only if live. Offsets count characters. Null and empty texts
    have no spans; repeated rows are one document and get the same spans each.
    """
    found = written(candidates(docs, id_column, owner), "candidates")
    hits = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.*").distinct()
    judged = hits.join(ownership(found), "value").where("kind <> 'owned' or live")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", order.alias("_order"), "end", "kind", "documents", "owners", "live"))).alias("spans"))
    return found.join(spans, "row", "left").select(*(["row"] if rows else []), id_column, F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, _order: bigint, end: bigint, kind: string, documents: bigint, owners: bigint, live: boolean>>)")).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_column: str = "doc_id", owner: str = "source", mark: str = "[secret]") -> DataFrame:
    """``docs`` with live secrets replaced by ``mark``; copied examples and all else stay as they are."""
    names = docs.columns
    key, spans_name = fresh("row", names), fresh("spans", names)
    live = (
        scan(docs, id_column, owner, rows=True)
        .select(F.col("row").alias(key), F.filter("spans", lambda s: s["live"]).alias(spans_name))
        .where(F.size(spans_name) > 0)
        .dropDuplicates([key])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(spans_name).to_pylist()):
                if text is None or not spans:
                    out.append(text)
                    continue
                shown, parts, at = text.decode(), [], 0
                for start, end in sorted((s["start"], s["end"]) for s in spans):
                    if start >= at:
                        parts += [shown[at:start], mark]
                    at = max(at, end)
                out.append("".join([*parts, shown[at:]]).encode())
            columns = [pa.array(out, pa.binary()).cast(pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    shown = [F.col(f"`{c}`").cast("binary").alias(c) if c == "text" else F.col(f"`{c}`") for c in names]
    merged = docs.select(*shown, row_key(id_column, owner).alias(key)).join(live, key, "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = arrow_map(merged.select(*[f"`{c}`" for c in names], spans_name), run, schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in names])
