"""Null ids, repeated rows, very long texts, ties and clashing extra columns, for the operators that meet them nowhere else."""

import random
from collections import Counter

import brute
import pytest
from ledgerline.llm import attribution, credentials, decontaminate, hosts, packing, shuffle, tokens, toxicity
from pyspark.sql import functions as F
from test_operators import WORDS, shared, spark  # noqa: F401
from tokenizers import Tokenizer

PASSAGE = " ".join(WORDS[300:320])
LONG = " ".join(random.Random(5).choices(WORDS[:250], k=60_000)) + f" {PASSAGE} password = abcdefgh1234"


@pytest.fixture(scope="module")
def odd():
    """(id, text): a null id with and without text, one id with two texts, equal rows, a long text."""
    return [(None, "no id\nbut words"), (None, None), (1, "first text"), (1, "second text of one id"), (2, PASSAGE), (2, PASSAGE), (3, LONG), (4, ""), (5, "\n\n"), (5, "\n\n")]


def frame(spark, rows):  # noqa: F811
    return brute.documents(spark, [t for _, t in rows], [i for i, _ in rows], extra=True)


def test_packing(spark, odd):  # noqa: F811
    tokenizer = Tokenizer.from_file(tokens.default_path())
    expected = Counter()
    for i, t in odd:
        expected[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    packed, sequences = Counter(), {}
    for r in packing.pack(frame(spark, odd)).collect():
        packed[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert packed == expected
    for pieces in sequences.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= packing.LENGTH


def test_shards(spark, odd):  # noqa: F811
    docs = frame(spark, odd).select("doc_id", "text", "shard", "_n", "key")
    out = shuffle.shuffle(docs, shards=3).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(odd)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(map(len, slots.values())) == [3, 3, 4] and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_secrets(spark, odd):  # noqa: F811
    found = credentials.scan(frame(spark, odd)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in odd)
    (long,) = [r for r in found if r.doc_id == 3]
    base = [s for s in long.spans if s.kind == "assign"]
    assert [(s.start, s.end) for s in base] == [(LONG.index("password"), len(LONG))]
    kept = credentials.redact(frame(spark, odd)).collect()
    assert Counter((r.doc_id, r.text) for r in kept if r.doc_id != 3) == Counter(x for x in odd if x[0] != 3)


def test_toxicity(spark, odd):  # noqa: F811
    rng = random.Random(7)
    rows = [(10 + i, " ".join(rng.choices(WORDS[:100], k=30) + (["vileness", "hatefulness"] * 4 if i % 3 == 0 else []))) for i in range(90)]
    docs = frame(spark, odd + rows + [(100, rows[0][1])])
    marks = spark.createDataFrame([(10 + i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (11, None), (12, 0), (12, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled(docs, marks))
    scores = toxicity.score(docs, model, keep=("text", "signature"), name="likely").collect()
    assert Counter((r.doc_id, r.text) for r in scores) == Counter(odd + rows + [(100, rows[0][1])])
    assert all(0 <= r.likely <= 1 for r in scores) and all(r.likely < 0.5 for r in scores if not (r.text or "").strip())
    by_text = {}
    for r in scores:  # equal texts tie
        assert by_text.setdefault(r.text, r.likely) == r.likely
    kept = toxicity.remove_toxic(docs, marks)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) >= Counter(i for i, _ in odd)


def test_decontamination(spark, odd):  # noqa: F811
    items = [(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (2, None)]
    found = decontaminate.scan(frame(spark, odd), spark.createDataFrame(items, "item_id bigint, text string"), keep=("spans",), prefix="x_").collect()
    assert len(found) == len(odd)
    for r in found:
        assert (r.x_n_words, r.x_n_hit, list(r.x_items)) == brute.hits(text_of(odd, r), [("" if i is None else i, t) for i, t in items])


def text_of(rows, r):
    """The text of a result row: of its id's texts, the one with as many words."""
    return next(t for i, t in rows if i == r.doc_id and brute.hits(t, [])[0] == r.x_n_words)


def test_reputation(spark):  # noqa: F811
    urls = [(None, "http://a.org/x"), (1, "http://a.org/x"), (1, "http://a.org/x"), (2, None), (3, "http://b.org/" + "y" * 300_000), (4, "http://" + "z" * 300_000)]
    pages = spark.createDataFrame(urls, "page_id bigint, url string").selectExpr("*", "1 as host", "2 as path", "3 as verdict", "4 as rule", "5 as domain", "6 as toxic")
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (None, 0, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = hosts.judge(pages, labels).collect()
    assert Counter(r.page_id for r in out) == Counter(i for i, _ in urls)
    assert {r.page_id: len(r.path) for r in out}[3] == 1 + 300_000
    assert len({r.verdict for r in out if r.host == "a.org"}) == 1


def test_token_counts(spark, odd):  # noqa: F811
    path = attribution.vocabulary(attribution.BYTE_RANKS)
    expected, got, sections = Counter(), Counter(), Counter()
    for i, t in odd:
        expected[i] += len(attribution.token_spans((t or "").encode(), path)) - 1
    for r in attribution.count(frame(spark, odd)).collect():
        got[r.doc_id] += r.n_tokens
        sections[r.doc_id] += 1
    assert got + Counter() == expected + Counter()
    assert sections == {None: 3, 1: 2, 2: 2, 3: 1, 4: 1, 5: 4}
