"""Generalised suffix automaton of word sequences."""

from __future__ import annotations


class SuffixAutomaton:
    """Suffix automaton of word sequences that arrive one by one; transitions are dictionaries keyed by word."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _state(self, length: int, link: int, moves: dict[bytes, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state of p's strings followed by word; parts it from q if q also has longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if (known := self.next[last].get(word)) is not None:  # an earlier sequence had it
            return self._split(last, known, word)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][word], word)
        return new

    def matching(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """At each word, the state and the length of the longest suffix read so far that some learnt sequence contains."""
        state, length, states, lengths = 0, 0, [], []
        following, links, longest = self.next, self.link, self.length
        for word in words:
            while state and word not in following[state]:
                state = links[state]
                length = longest[state]
            if (to := following[state].get(word)) is not None:
                state, length = to, length + 1
            states.append(state)
            lengths.append(length)
        return states, lengths

    def suffix(self, state: int, length: int) -> int:
        """The state of the suffix of that length of a match that ends in state."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state
