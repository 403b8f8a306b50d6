"""A suffix automaton over word numbers that remembers where each substring was first seen."""

from __future__ import annotations


class SuffixAutomaton:
    """Built online from texts in the order of their labels; label order is the caller's.

    Every state stands for substrings with the same ends; ``first`` is the label of the text that
    brought them, the smallest if labels never fall.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _add(self, length: int, following: dict[int, int], link: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, at: int, symbol: int, old: int) -> int:
        """Parts the substrings of ``old`` that end a step from ``at`` from its longer ones."""
        new = self._add(self.length[at] + 1, dict(self.next[old]), self.link[old], self.first[old])
        self.link[old] = new
        while at >= 0 and self.next[at].get(symbol) == old:
            self.next[at][symbol] = new
            at = self.link[at]
        return new

    def insert(self, words: list[int], label: int) -> None:
        last = 0
        for symbol in words:
            known = self.next[last].get(symbol)
            if known is not None:
                exact = self.length[known] == self.length[last] + 1
                last = known if exact else self._split(last, symbol, known)
                continue
            new, at = self._add(self.length[last] + 1, {}, 0, label), last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = new
                at = self.link[at]
            if at >= 0:
                known = self.next[at][symbol]
                exact = self.length[known] == self.length[at] + 1
                self.link[new] = known if exact else self._split(at, symbol, known)
            last = new

    def first_seen(self, words: list[int], size: int) -> list[int | None]:
        """For each window of ``size`` words, the label of the first text that has it, or None.

        The matching statistics (the longest match that ends at each word) come from one walk; where
        one is long enough, suffix links lead to the state that holds the last ``size`` words.
        """
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        out: list[int | None] = []
        for i, symbol in enumerate(words):
            while state and symbol not in following[state]:
                state = link[state]
                matched = length[state]
            if symbol in following[state]:
                state = following[state][symbol]
                matched += 1
            if i >= size - 1:
                if matched < size:
                    out.append(None)
                    continue
                at = state
                while length[link[at]] >= size:
                    at = link[at]
                out.append(self.first[at])
        return out
