"""Spelling variants against all deletions and replacements of a small vocabulary."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from ledgerline.llm import variants

SCHEMA = "doc_id bigint, text string"


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_forms(counts):
    near, cuts = defaultdict(set), defaultdict(list)
    for word in counts:
        for i in range(len(word)):
            shorter = word[:i] + word[i + 1 :]
            if shorter in counts:
                near[word].add(shorter)
                near[shorter].add(word)
            cuts[shorter, i].append(word)
    for group in cuts.values():
        for word in group:
            near[word].update(other for other in group if other != word)
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * n else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return sorted((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items())


def got(spark, counts):
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return sorted(tuple(r) for r in variants.forms(frame).select("word", "form", "root", "n", "n_near", "form_n").collect())


def mutated(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:i] + rng.choice(letters) + word[i:]
    i = min(i, len(word) - 1)
    return word[:i] + (rng.choice(letters) if kind == 1 else "") + word[i + 1 :]


@pytest.mark.parametrize("letters, lengths", [("ab", (7, 9)), ("abcé×ÿz", (7, 14)), ("ab", (37, 46))])
def test_pairs_match_brute_force(spark, letters, lengths):
    rng = random.Random(len(letters) + lengths[0])
    words = {"".join(rng.choices(letters, k=rng.randint(*lengths))) for _ in range(60)}
    for _ in range(3):
        words |= {m for w in list(words) for m in [mutated(rng, w, letters)] if len(m) >= 7}
    words |= {"a" * n for n in range(7, 12)} | {"ab" * 5, "ba" * 5, "ab" * 5 + "a"}
    counts = {w: rng.choice([2, 3, 25, 300, 4000, 50000]) for w in sorted(words)}
    assert got(spark, counts) == plain_forms(counts)


def test_ties_and_chains(spark):
    chain = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000}
    ties = {"zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30}
    rows = {r[0]: r for r in got(spark, chain | ties)}
    assert sorted(rows.values()) == plain_forms(chain | ties)
    assert rows["aaaaaaa"][2] == "aaabbbb" and rows["zzzzzzz"][1] == "zzzzzzx"


def test_very_long_words(spark):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh", k=20_000))
    words = [long, long[:9000] + "z" + long[9001:], long[:19_999], "q" + long, long[::-1], "a" * 5000, "a" * 4999, "b" + "a" * 4999]
    counts = {w: 2 + 40 * i for i, w in enumerate(words)}
    rows = {r[0]: r for r in got(spark, counts)}
    assert {w: rows[w][4] for w in words} == {words[0]: 3, words[1]: 1, words[2]: 1, words[3]: 1, words[4]: 0, words[5]: 2, words[6]: 2, words[7]: 2}


def test_hot_prefixes_and_many_neighbours(spark):
    counts = {f"common{a}{b}": 2 for a in "abcdefghij" for b in "abcdefghij"} | {"commonaa": 900}
    assert got(spark, counts) == plain_forms(counts)


def test_words_of_documents(spark):
    rng = random.Random(9)
    base = ["Ordinary", "ORDINARY", "straße", "Àéîõüÿs", "été-long", "tiny", "d'accord", "mañana", "naïvely×words", "日本語textual"]
    rows = [(i, " ".join(rng.choices(base, k=60)) + rng.choice([".", "\n", "\x00"])) for i in range(60)]
    rows += [(None, "Ordinary ordinary"), (70, None), (71, ""), (72, " \t"), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as run", "3 as word", "4 as n")
    found = {r.word: r.n for r in variants.words(frame).collect()}
    assert found == plain_words(rows) and any(w not in {"ordinary"} for w in found)


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n bigint")
    assert variants.forms(empty).count() == 0 and variants.words(spark.createDataFrame([], SCHEMA)).count() == 0
