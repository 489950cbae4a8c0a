"""Token ids of whole texts by the tokenizers library, with a per-process memory of words."""

from __future__ import annotations

import os
import re
from array import array

from .common import vocabulary

WORD_BPE = "word_bpe_49k.json"
END = 1

# Runs of text a Python worker remembers, before the older half is forgotten; about 200 bytes each.
REMEMBERED = 600_000
# Longer runs (in bytes) are not remembered.
LONGEST = 40

# Printable ASCII and Latin letters of U+00C0 to U+00FF: unchanged by NFC, lower-cased one to one.
_PLAIN = re.compile(r"[!-~À-ÿ]+")
_TAILED = re.compile(rb"([a-z]+)([!-&(-/:;=-@\[-`{}~]+)")
_LETTERS = re.compile(r"[a-zà-öø-ÿß]+")
# The vocabulary's own splits (fixed): letter runs, single digits, runs of anything else.
_PIECES = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+|[0-9]|[^0-9a-zA-ZÀ-ÖØ-öø-ÿ]+")


class WordTokens(dict):
    """Bytes of a white-space-free run of text to its ids as little-endian unsigned 32-bit integers.

    This vocabulary drops white space before it looks at anything, so the ids of
    a text are those of its runs in order. Runs of letters go straight to the
    library's BPE model; others are split at the vocabulary's own borders, and
    whatever is not plain Latin text goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # the character that stands for each byte that occurs in plain letters
        self.shown = {b: shown(chr(b))[0][0] for b in range(ord("a"), ord("z") + 1)}
        for letter in "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ":
            self.shown |= dict(zip(letter.encode(), shown(letter)[0][0]))
        self.older: dict[bytes, bytes] = {}

    def _whole(self, run: str) -> bytes:
        return array("I", self.library.encode(run, add_special_tokens=False).ids).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode() if word.isascii() else word.decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.tokenize(text)]).tobytes()

    def _split(self, key: bytes) -> bytes:
        tailed = _TAILED.fullmatch(key)
        if tailed:
            return self[tailed[1]] + self[tailed[2]]
        run = key.decode()
        if not _PLAIN.fullmatch(run) or "'" in run or "<|" in run:
            return self._whole(run)
        run = run.lower()
        if _LETTERS.fullmatch(run):
            return self._word(run.encode())
        parts = _PIECES.findall(run)
        return self._whole(run) if len(parts) == 1 else b"".join([self[p.encode()] for p in parts])

    def __missing__(self, key: bytes) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self._split(key)
            if len(key) > LONGEST:
                return ids
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        self[key] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        """Ids of a whole text, serialized."""
        runs = text.split() if b"<|" in text else text.lower().split()
        return b"".join(map(self.__getitem__, runs))


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One memory for each worker process, kept from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def default_path() -> str:
    return vocabulary(WORD_BPE)
