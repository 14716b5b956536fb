"""Wu-Manber search for many runs of words of one length.

The letters are words, as numbers; what no pattern holds is 0. A block is the last words of a
window (two, or one in patterns of one word). The shift table tells by the hash of a block how
far the window may move without passing an occurrence: its distance from the end of the
nearest pattern that holds the block, the most where none does. Where that is 0, patterns that
end in the block and begin alike are found in buckets by hash, and compared word by word.

Many windows move at a time, each over a stretch of its own, so one array operation serves
thousands of them.
"""

from __future__ import annotations

import numpy as np

from tidelog.llm.texts import flat_ranges, mixed

#: Windows that move side by side, and pairs of place and pattern that are compared at a time.
LANES, PAIRS = 2_048, 1 << 20
GOLD = np.uint64(0x9E3779B97F4A7C15)


class Search:
    """Tables for distinct patterns, one in a row, of numbers above 0."""

    def __init__(self, patterns: np.ndarray):
        self.length = patterns.shape[1]
        self.block = min(2, self.length)
        many = max(1, patterns.size)
        size = min(22, max(10, int(many * 16).bit_length()))  # a power of two
        self.bits = np.uint64(64 - size)
        most = min(self.length - self.block + 1, np.iinfo(np.int16).max)
        self.shift = np.full(1 << size, most, np.int16)
        for end in range(self.block - 1, self.length):
            at = self._hash([patterns[:, end - step] for step in range(self.block)])
            np.minimum.at(self.shift, at, min(self.length - 1 - end, most))
        key = self._key([patterns[:, k] for k in range(self.length)])
        order = np.argsort(key, kind="stable")
        self.patterns, self.keys, self.order = patterns[order], key[order], order

    def _hash(self, last: list[np.ndarray]) -> np.ndarray:
        """The place in the shift table of a block, given last word first."""
        found = last[0].astype(np.uint64) * GOLD
        for word in last[1:]:
            found = (found ^ (found >> np.uint64(29))) * GOLD + word.astype(np.uint64) * GOLD
        return ((found ^ (found >> np.uint64(32))) * GOLD >> self.bits).astype(np.int64)

    def _key(self, words: list[np.ndarray]) -> np.ndarray:
        """The bucket of a window: hashed from its last block and its first two words."""
        found = mixed(words[-1])
        for word in (words[-self.block], words[0], words[min(1, self.length - 1)]):
            found = mixed(found ^ word.astype(np.uint64))
        return found

    def occurrences(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence in the run of numbers ``words``."""
        nothing = np.zeros(0, np.int64)
        first, last = self.length - 1, len(words)
        if last <= first or not len(self.patterns):
            return nothing, nothing
        stretch = -(-(last - first) // LANES)
        at = np.arange(first, last, stretch)
        stop = np.minimum(at + stretch, last)
        met = [nothing]
        while len(at):
            step = self.shift[self._hash([words[at - back] for back in range(self.block)])]
            met.append(at[step == 0])
            at = at + np.maximum(step, 1).astype(np.int64)
            going = at < stop
            at, stop = at[going], stop[going]
        return self._confirmed(words, np.sort(np.concatenate(met)) - first)

    def _confirmed(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self._key([words[starts + k] for k in range(self.length)])
        low = np.searchsorted(self.keys, key, "left")
        many = np.searchsorted(self.keys, key, "right") - low
        starts, low, many = starts[many > 0], low[many > 0], many[many > 0]
        found, numbers = [], []
        edges = np.append(0, np.cumsum(many))
        done = 0
        while done < len(starts):  # pairs are bounded, but a bucket is compared in one go
            stop = max(done + 1, int(np.searchsorted(edges, edges[done] + PAIRS, "right")) - 1)
            place = np.repeat(starts[done:stop], many[done:stop])
            pattern = flat_ranges(low[done:stop], many[done:stop])
            for k in range(self.length):
                same = words[place + k] == self.patterns[pattern, k]
                place, pattern = place[same], pattern[same]
            found.append(place)
            numbers.append(self.order[pattern])
            done = stop
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(numbers)
