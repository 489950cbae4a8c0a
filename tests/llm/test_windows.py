"""Decontamination against benchmarks too large to ship, with every limit set so low that all ways are taken."""

import random

import brute
import pytest
from ledgerline.llm import decontaminate, windows
from pyspark.sql import functions as F
from test_operators import ODD, WORDS, benchmark, shared, spark  # noqa: F401


@pytest.fixture(params=[64, 1 << 16])
def small(request, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHIPPED_BYTES", 0)
    monkeypatch.setattr(windows, "FILTER_BYTES", request.param)
    monkeypatch.setattr(windows, "AUTOMATON_BYTES", 300)
    monkeypatch.setattr(windows, "STRETCH", 7)
    monkeypatch.setattr(windows, "TASK_BYTES", 400)


def cases():
    rng = random.Random(21)
    few = WORDS[:12]
    items = [(i, " ".join(rng.choices(few, k=rng.choice([1, 4, 9, 10, 11, 30])))) for i in range(12)]
    items += [(100 + i, " ".join(rng.choices(WORDS, k=rng.choice([3, 10, 40])))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "..."), (None, " ".join(WORDS[200:215])), (3, "Another, text; of item 3 - with ten words or so é"), (100, items[12][1])]
    texts = [" ".join(rng.choices(few + WORDS[:60], k=rng.randint(1, 200))) for _ in range(30)] + ODD
    texts += [f"before {text} after. {items[(i * 5 + 1) % 42][1]}" for i, (_, text) in enumerate(items[:42])]
    texts += [f"{i} one passage of many: {items[20][1]}" for i in range(40)] + ["x " * 3000 + items[20][1]] * 2 + [texts[3]] * 5 + [f"É {' '.join(WORDS[200:215])}"]
    return texts, items


def test_large_benchmark_matches_brute_force(spark, small):  # noqa: F811
    texts, items = cases()
    named = [("" if i is None else i, t) for i, t in items]
    found = decontaminate.scan(brute.documents(spark, texts, extra=True), benchmark(spark, items)).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    for r in found:
        assert (r.n_words, r.n_hit, list(r["items"])) == brute.hits(texts[r.doc_id], named)


def test_large_and_shipped_benchmarks_cut_alike(spark, small, monkeypatch):  # noqa: F811
    texts, items = cases()
    docs = brute.documents(spark, texts, extra=True).withColumn("found", F.lit(1)).withColumn("Digest", F.lit("d"))
    docs = docs.union(docs.limit(40).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    columns = [f"`{c}`" for c in docs.columns]

    def rows():
        out = decontaminate.remove_contamination(docs, benchmark(spark, items))
        assert out.columns == docs.columns
        return sorted(map(repr, out.select(*columns).collect()))

    large = rows()
    monkeypatch.setattr(decontaminate, "SHIPPED_BYTES", 1 << 20)
    assert large == rows()


def test_large_benchmark_goes_by_groups(spark, small):  # noqa: F811
    texts, items = cases()
    table = benchmark(spark, items * 3)
    size = table.agg(F.sum(F.octet_length("text"))).first()[0]
    groups = windows.grouped(table, size)
    assert groups.count() == len({(i, t) for i, t in items if t is not None})
    assert groups.select("group").distinct().count() > 5
    assert groups.groupBy("group").agg(F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0] < size / 3


def test_large_benchmark_and_no_documents(spark, small):  # noqa: F811
    _, items = cases()
    assert decontaminate.scan(brute.documents(spark, []), benchmark(spark, items)).count() == 0
    clean = decontaminate.scan(brute.documents(spark, ["nothing of it", None]), benchmark(spark, items)).collect()
    assert sorted((r.n_words, r.n_hit) for r in clean) == [(0, 0), (3, 0)]
