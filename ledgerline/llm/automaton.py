"""Generalised suffix automaton over the words of benchmark items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

WINDOW = 10

# Bytes of benchmark text one automaton is built from; more text makes more automata.
AUTOMATON_BYTES = 2 << 20


class Automaton:
    """Every run of words of the items, with the items whose windows end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in words]) for item, words in items if words]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        self.sizes = sorted({min(window, len(codes)) for _, codes in coded}, reverse=True)
        self.owners: dict[tuple[int, int], set[str]] = defaultdict(set)
        for item, codes in coded:
            size, state = min(window, len(codes)), 0
            for i, code in enumerate(codes):
                state = self.next[state][code]
                if i + 1 >= size:
                    self.owners[size, self._class(state, size)].add(item)
        self.shortest = self.sizes[-1] if self.sizes else 0

    def _new(self, length: int, arcs: dict[int, int], link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(code) == target:
            self.next[state][code] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, code: int) -> int:
        target = self.next[last].get(code)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, code, target)
        new, state = self._new(self.length[last] + 1, {}, 0), last
        while state >= 0 and code not in self.next[state]:
            self.next[state][code] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][code]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, code, target)
        return new

    def _class(self, state: int, size: int) -> int:
        """The state that holds the last ``size`` words of ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(position, window length, items) for every window that ends at a word."""
        state = matched = 0
        for i, word in enumerate(words):
            code = self.ids.get(word)
            if code is None:
                state = matched = 0
                continue
            while state and code not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if code in self.next[state]:
                state = self.next[state][code]
                matched += 1
            else:
                matched = 0
            for size in self.sizes:
                if matched >= size and (items := self.owners.get((size, self._class(state, size)))):
                    yield i, size, items
