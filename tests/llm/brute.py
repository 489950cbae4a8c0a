"""Plain restatements of what the operators compute, and small tables for them."""

from __future__ import annotations

import re

TABLE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None, extra=False):
    """Documents with the given texts; ``extra`` adds columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    frame = spark.createDataFrame(rows, TABLE)
    if extra:
        for name in ("row", "node", "shard", "slot", "_n", "a", "b", "spans", "signature", "component", "toxicity", "start", "length", "key"):
            frame = frame.selectExpr("*", f"cast(null as int) as `{name}`")
    return frame


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text, size):
    words = spaced(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(texts, size, least=80, whole=100):
    """Smallest id reachable over all pairs of (id, text)."""
    sets = {i: shingles(t, size) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and whole * len(a & b) >= least * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def hits(text, items, window=10):
    """(words, hit words, ids of items with occurring windows) by looking at every place."""
    words, hit, found = alnum(text), set(), set()
    for item, other in items:
        theirs = alnum(other)
        size = min(window, len(theirs))
        for k in range(len(theirs) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == theirs[k : k + size]:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


_KINDS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}


def secrets(text):
    """(kind, start, end) of base spans in order."""
    found = []
    for rank, (kind, pattern) in enumerate(_KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            if (kind == "assign" and len(m[2]) >= 8) or (kind == "access" and len(m[0]) >= 16) or (kind == "hex" and len(m[0]) >= 32):
                found.append((m.start(), rank, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def cut(text, items, window=10):
    """Text without the stretches that items share, None if over half of its words are hit."""
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]
    words, hit = alnum(text), set()
    for _, other in items:
        theirs = alnum(other)
        size = min(window, len(theirs))
        runs = {tuple(theirs[k : k + size]) for k in range(len(theirs) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in runs:
                hit.update(range(i, i + size))
    if 2 * len(hit) > len(words):
        return None
    parts, at = [], 0
    for i in sorted(hit):
        start = places[i][0] if i - 1 not in hit else places[i - 1][1]
        parts.append(text[at:start])
        at = places[i][1]
    return "".join([*parts, text[at:]])


def masked(docs, find, owners=3, documents=20, mark="[secret]"):
    """Texts of (id, owner, text) with the secrets masked that few owners and few documents have."""
    have = {}
    for i, owner, text in docs:
        for _, _, _, value in find(text):
            have.setdefault(value, set()).add((i, owner))
    out = {}
    for i, _, text in docs:
        shown, at = "", 0
        for start, end in sorted((a, b) for _, a, b, v in find(text) if len({o for _, o in have[v]}) < owners and len(have[v]) < documents):
            if start >= at:
                shown += text[at:start] + mark
            at = max(at, end)
        out[i] = shown + text[at:]
    return out
