"""Conversation prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from ledgerline.llm import dialogues

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [(r, t) for _, _, r, t in sorted(own, key=lambda x: x[:2])] for c, own in convs.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = plain.get(c - c % 100, [])[:h] + own[h:]
    return out


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = set()
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below)
        ends = sorted(c for c in inside if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        found.add((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children), len(leaves), saved, digest))
    return found


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in dialogues.rebuilt_trie(frame).collect()]
    expected = nodes(rebuilt(rows))
    assert len(got) == len(expected) and set(got) == expected
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_plain_prefixes(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(97, 130), 300, 5001, 5002]:
        for turn in range(rng.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é日", "", None])))
    rows += [(c, None, "system", "first") for c in (3, 4, 98)]  # a null turn comes first
    rows += [(None, 0, "user", "of no conversation")]
    check(spark, rows)


def test_hot_conversations_share_a_leaf(spark):
    rows = [(c, t, "user", f"text {t}") for c in range(1000, 1090) for t in range(3)] + [(c, 0, "user", "other") for c in range(1090, 1100)]
    got = check(spark, rows)
    assert max(r[3] for r in got) == 100


def test_long_conversation_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(dialogues, "BLOCK", 4)
    monkeypatch.setattr(dialogues, "CHUNK", 8)
    rows = [(200, t, "user", "x" * (t % 3)) for t in range(50)] + [(c, t, "user", "x" * (t % 3)) for c in range(201, 230) for t in range(c % 7)]
    check(spark, rows)


def test_equal_turn_numbers_go_by_digest_and_repeated_rows_are_turns(spark):
    rows = [(6, 1, "user", t) for t in ("b", "a", "a")]
    one = dialogues.rebuilt_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    two = dialogues.rebuilt_trie(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect()
    assert sorted(one) == sorted(two)
    h = zlib.crc32(b"6") % 6
    assert max(r.depth for r in one) == max(0, 3 - h)


def test_turnless_conversations_end_at_the_root(spark):
    lonely = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    (root,) = dialogues.rebuilt_trie(spark.createDataFrame([(lonely, 0, "user", "gone")], SCHEMA)).collect()
    assert (root.conv_id, root.depth, root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves) == (lonely, 0, None, 1, 0, 1)
    assert root.ends_sha256 == hashlib.sha256(str(lonely).encode()).hexdigest()


def test_clashing_extra_columns_and_no_rows(spark):
    rows = [(c, t, "user", str(t)) for c in range(3) for t in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    wide = frame.selectExpr("*", "1 as block", "2 as position", "'x' as digest", "3 as rows", "4 as k1")
    assert sorted(dialogues.rebuilt_trie(wide).collect()) == sorted(dialogues.rebuilt_trie(frame).collect())
    empty = dialogues.rebuilt_trie(frame.limit(0))
    assert empty.columns[0] == "conv_id" and empty.count() == 0
