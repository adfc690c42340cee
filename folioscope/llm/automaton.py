"""A generalised suffix automaton over word hashes, and matching statistics of word streams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np


class SuffixAutomaton:
    """All factors of a bounded set of sequences of small integers.

    ``where[state]`` maps each sequence that holds the state's strings to the end of one of
    their occurrences.  It is kept for states with strings of ``least`` symbols or more.
    """

    def __init__(self, sequences: Iterable[Sequence[int]], least: int = 1) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.where: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            state = 0
            for end, symbol in enumerate(sequence):
                state = self._extend(state, symbol)
                self.where[state].setdefault(number, end)
        self._spread(least)

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.where.append({})
        return len(self.next) - 1

    def _split(self, parent: int, symbol: int, child: int) -> int:
        """A copy of ``child`` for the strings that end behind ``parent``."""
        clone = self._state(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = clone
        while parent >= 0 and self.next[parent].get(symbol) == child:
            self.next[parent][symbol] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, symbol, known)
        fresh = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = fresh
            at = self.link[at]
        if at >= 0:
            child = self.next[at][symbol]
            exact = self.length[child] == self.length[at] + 1
            self.link[fresh] = child if exact else self._split(at, symbol, child)
        return fresh

    def _spread(self, least: int) -> None:
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True)
        for state in by_length:
            parent = self.link[state]
            if parent > 0 and self.length[parent] >= least:
                into = self.where[parent]
                for number, end in self.where[state].items():
                    into.setdefault(number, end)

    def statistics(self, symbols: Sequence[int]) -> Iterator[tuple[int, int]]:
        """For each position the length of the longest factor that ends there, and its state."""
        state = matched = 0
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            target = self.next[state].get(symbol)
            if target is None:
                state = matched = 0
            else:
                state, matched = target, matched + 1
            yield matched, state

    def cut(self, state: int, size: int) -> int:
        """The state of the last ``size`` symbols of a match that ended in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


class Vocabulary:
    """Small integers for the word hashes of a set of sequences, and their neighbours."""

    def __init__(self, sequences: Sequence[np.ndarray]) -> None:
        every = np.concatenate(sequences) if sequences else np.empty(0, np.uint64)
        self.hashes = np.unique(every)
        self.sequences = [np.searchsorted(self.hashes, s).astype(np.int64) for s in sequences]
        pairs = [s[:-1] * len(self.hashes) + s[1:] for s in self.sequences if len(s) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """The integer of each word, -1 for words that no sequence has."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1)

    def candidates(
        self, codes: np.ndarray, rows: np.ndarray, least: int
    ) -> list[tuple[int, int]]:
        """Stretches that can hold a common factor of ``least`` words or more.

        Inside a stretch every word and every pair of neighbours occurs in a sequence, which
        any common factor satisfies; a stretch stays within its row.
        """
        known = codes >= 0
        if not known.any():
            return []
        joined = np.zeros(len(codes), bool)  # continues the word in front of it
        both = known[1:] & known[:-1]
        at = np.flatnonzero(both) + 1
        if len(at) and len(self.pairs):
            pair = codes[at - 1] * len(self.hashes) + codes[at]
            place = np.searchsorted(self.pairs, pair)
            place[place == len(self.pairs)] = 0
            joined[at] = self.pairs[place] == pair
        joined[rows[:-1][rows[:-1] < len(codes)]] = False
        starts = np.flatnonzero(known & ~joined)
        after = np.append(joined[1:], False)
        ends = np.flatnonzero(known & ~after) + 1
        long = ends - starts >= least
        return list(zip(starts[long].tolist(), ends[long].tolist()))
