"""A generalised suffix automaton of token sequences, streamed to find what texts share with them.

It accepts every run of consecutive tokens of every sequence. Streaming a text through it gives,
after each token, the longest run ending there that some sequence holds, in time linear in the
text. Before that, numpy drops what can't matter: tokens that no sequence has, and places where
two neighbours stand together in no sequence, break the text into stretches; only stretches as
long as the shortest match asked for are streamed.
"""

from collections.abc import Iterator

import numpy as np


class SuffixAutomaton:
    """next, link and length by state; state 0 is the empty run."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.sequences = sequences
        for tokens in sequences:
            last = 0
            for token in tokens:
                last = self._extend(last, token)

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, token: int) -> int:
        """The state of p's longest run and the token, set apart from longer ones if need be."""
        q = self.next[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, token)
        return new

    def owners(self) -> list[set[int]]:
        """For each state, the sequences that hold its runs."""
        found: list[set[int]] = [set() for _ in self.length]
        for k, tokens in enumerate(self.sequences):
            state = 0
            for token in tokens:
                state = self.next[state][token]
                v = state
                while v > 0 and k not in found[v]:
                    found[v].add(k)
                    v = self.link[v]
        return found

    def ends(self) -> list[dict[int, list[int]]]:
        """For each state, the sequences that hold its runs, and all places where they end."""
        found: list[dict[int, list[int]]] = [{} for _ in self.length]
        for k, tokens in enumerate(self.sequences):
            state = 0
            for at, token in enumerate(tokens):
                state = self.next[state][token]
                v = state
                while v > 0:
                    found[v].setdefault(k, []).append(at)
                    v = self.link[v]
        return found

    def stream(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """After each token, the state and length of the longest run that ends with it."""
        after, link, lengths = self.next, self.link, self.length
        state = n = 0
        for token in tokens:
            while token not in after[state] and state:
                state = link[state]
                n = lengths[state]
            if token in after[state]:
                state = after[state][token]
                n += 1
            yield state, n


class Vocabulary:
    """Tokens by their 64-bit hash, numbered; and which of them stand side by side."""

    def __init__(self, sequences: list[np.ndarray]):
        self.hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *sequences]))
        self.numbered = [np.searchsorted(self.hashes, s) for s in sequences]
        pairs = [s[:-1] * len(self.hashes) + s[1:] for s in self.numbered if len(s) > 1]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each token's number, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def stretches(self, numbers: np.ndarray, first: np.ndarray, least: int) -> list[tuple[int, int]]:
        """Ranges of known tokens, within one text each, whose neighbours some sequence has too."""
        if not len(numbers) or not len(self.hashes):
            return []
        joined = np.zeros(len(numbers) + 1, bool)  # with the token before
        both = np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0))
        if len(both) and len(self.pairs):
            code = numbers[both] * len(self.hashes) + numbers[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined[both[self.pairs[at] == code] + 1] = True
        joined[first[first < len(numbers)]] = False
        heads = np.flatnonzero((numbers >= 0) & ~joined[:-1])
        tails = np.flatnonzero((numbers >= 0) & ~joined[1:]) + 1
        kept = tails - heads >= least
        return list(zip(heads[kept].tolist(), tails[kept].tolist(), strict=True))
