"""Bin completion over counts of item sizes.

Items of one size are alike, so a packing is a short list of fillings, each with the
number of bins that hold it. The search takes the largest size left, lists all undominated
fillings of the room beside it as they are needed, uses one as often as the counts allow, then
less often, and goes on with what is left. A branch is given up when its waste shows that it
cannot beat the best packing so far; best-fit decreasing gives the first. A search that ends
before MOST_STEPS has proved its packing to be the best.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np

Filling = tuple[tuple[int, int], ...]  #: (size, how many), largest size first

#: Steps of the search: fillings looked at and fillings used.
MOST_STEPS = 60_000
#: So many levels of the search keep their sums; those further up make them again.
KEPT_LEVELS = 64


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs (Martello and Toth's bound over all thresholds).

    ``counts[s]`` is the number of items of size ``s``; the last index is the room of a bin.
    """
    room = len(counts) - 1
    sizes = np.arange(room + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    half = room // 2
    best = -(-int(total[-1]) // room)
    for low in range(half + 1):
        alone = int(number[-1] - number[room - low])
        large = int(number[room - low] - number[half])
        in_large = int(total[room - low] - total[half])
        small = int(total[half] - (total[low - 1] if low else 0))
        rest = small - (large * room - in_large)
        best = max(best, alone + large + max(0, -(-rest // room)))
    return best


def best_fit(counts: np.ndarray) -> list[tuple[int, Filling]]:
    """Best-fit decreasing: (number of bins, filling)."""
    room = len(counts) - 1
    free: dict[int, list[tuple[int, tuple]]] = {}  # room left -> bins alike
    left = np.zeros(room + 1, bool)
    for size in range(room, 0, -1):
        items = int(counts[size])
        while items:
            at = size + int(np.argmax(left[size:])) if left[size:].any() else 0
            if at:
                bins, filling = free[at].pop()
                left[at] = bool(free[at])
                if bins > items:
                    free[at].append((bins - items, filling))
                    left[at], bins = True, items
                fit = 1
            else:
                fit = min(room // size, items)
                at, bins, filling = room, items // fit, ()
            items -= bins * fit
            rest = at - fit * size
            free.setdefault(rest, []).append((bins, (*filling, (size, fit))))
            left[rest] = rest > 0
    packed: Counter[Filling] = Counter()
    for groups in free.values():
        for bins, filling in groups:
            merged: Counter[int] = Counter()
            for size, times in filling:
                merged[size] += times
            packed[tuple(sorted(merged.items(), reverse=True))] += bins
    return [(bins, filling) for filling, bins in packed.items()]


class Level:
    """The undominated fillings of a room by what ``counts`` holds now, least waste first.

    Sums that sizes can make are the bits of an integer. ``sums(n)`` has those of the n largest
    sizes, made when first asked for; a size is taken only where the larger ones can make the
    rest, so no walk ends without a filling.
    """

    def __init__(self, counts: np.ndarray, room: int, first: int = 0) -> None:
        sizes = np.flatnonzero(counts[: room + 1])[::-1]
        sizes = sizes[sizes > 0]
        self.room, self.first = room, first  #: ``first`` is the size that the room is beside
        self.sizes = array("i", sizes.astype(np.int32).tobytes())
        self.caps = array("i", np.minimum(counts[sizes], room // np.maximum(sizes, 1)).astype(np.int32).tobytes())
        #: the sizes as bits, and how many there are of each
        self.there = sum(1 << size for size in self.sizes)
        self.counts = counts[: room + 1].copy()
        self.made = [1]
        self.options = self._options()
        self.filling: Filling = ()
        self.lost = self.times = 0
        self.used: list[Filling] = []

    def sums(self, n: int) -> int:
        mask = (2 << self.room) - 1
        while len(self.made) <= n:
            size, left = self.sizes[len(self.made) - 1], self.caps[len(self.made) - 1]
            reached, some = self.made[-1], 1
            while left:
                some = min(some, left)
                reached |= reached << size * some & mask
                left -= some
                some *= 2
            self.made.append(reached)
        return self.made[n]

    def ways(self, n: int, rest: int) -> Iterator[Filling]:
        """All choices among the ``n`` largest sizes with sum ``rest``."""
        if not rest:
            yield ()
            return
        for j in range(bisect_left(self.sizes, -rest, 0, n, key=lambda size: -size), n):
            size = self.sizes[j]
            if not self.sums(j + 1) >> rest & 1:
                continue
            for times in range(1, min(self.caps[j], rest // size) + 1):
                if self.sums(j) >> rest - times * size & 1:
                    for more in self.ways(j, rest - times * size):
                        yield (*more, (size, times))

    def dominated(self, filling: Filling, waste: int) -> bool:
        """Some of the items leave their places to one other that is no smaller, and it fits."""
        there = self.there
        some = several = 0  # sums of one or more items, of two or more
        for size, times in filling:
            if self.counts[size] == times:
                there &= ~(1 << size)
            for _ in range(times):
                several |= (some | several) << size
                some |= (some | 1) << size
        if several & there:
            return True
        return bool(waste and self._above(some | 1, waste) & there)

    @staticmethod
    def _above(sums: int, most: int) -> int:
        """1 to ``most`` more than any of the sums."""
        reach, width = sums << 1, 1
        while width < most:
            step = min(width, most - width)
            reach |= reach << step
            width += step
        return reach

    def _options(self) -> Iterator[tuple[int, Filling] | None]:
        """(waste, filling with the size it is beside); None for a dominated one."""
        if self.there >> self.room & 1 and self.room:
            yield 0, self._with_first(((self.room, 1),))  # dominates all else
            return
        for goal in range(self.room, -1, -1):
            for found in self.ways(len(self.sizes), goal):
                waste = self.room - goal
                yield None if self.dominated(found, waste) else (waste, self._with_first(found))

    def _with_first(self, found: Filling) -> Filling:
        if found and found[0][0] == self.first:
            return ((self.first, found[0][1] + 1), *found[1:])
        return ((self.first, 1), *found)


def fillings(counts: np.ndarray, room: int) -> Iterator[tuple[int, Filling]]:
    """(waste, filling): all undominated fillings of ``room``, least waste first."""
    for found in Level(np.asarray(counts), room).options:
        if found:
            yield found[0], found[1][1:]


def pack(counts: np.ndarray) -> list[tuple[int, Filling]]:
    """A packing of all items as (number of bins, filling), within a fixed number of steps.

    Once all packings with a filling are searched, or all with more uses of it, none that
    holds it can be better: below and beside it, it need not be used again.
    """
    counts = np.asarray(counts, np.int64).copy()
    room = len(counts) - 1
    if not counts.any():
        return []
    best = best_fit(counts)
    fewest, least = sum(bins for bins, _ in best), lower_bound(counts)
    total = int((counts * np.arange(room + 1)).sum())
    searched: set[Filling] = set()
    bins = waste = steps = 0

    def level() -> Level:
        size = int(np.flatnonzero(counts)[-1])
        counts[size] -= 1
        found = Level(counts, room - size, size)
        counts[size] += 1
        return found

    def use(one: Level, times: int) -> None:
        nonlocal bins, waste
        for size, many in one.filling:
            counts[size] -= (times - one.times) * many
        bins += times - one.times
        waste += (times - one.times) * one.lost
        one.times = times

    levels = [level()]
    while levels and fewest > least and steps < MOST_STEPS:
        steps += 1
        one = levels[-1]
        allowed = (fewest - 1) * room - total
        if one.times > 1:
            use(one, one.times - 1)
        else:
            use(one, 0)
            found = next(one.options, (room + 1, ()))
            if found is None or found[1] in searched:
                continue
            if waste + found[0] > allowed:  # so do all later ones
                levels.pop()
                searched.difference_update(one.used)
                continue
            one.lost, one.filling = found
            searched.add(one.filling)
            one.used.append(one.filling)
            times = min(int(counts[size]) // many for size, many in one.filling)
            use(one, min(times, (allowed - waste) // one.lost) if one.lost else times)
        if waste > allowed:
            continue
        if counts.any():
            levels.append(level())
            if len(levels) > KEPT_LEVELS:
                del levels[-KEPT_LEVELS - 1].made[1:]
        elif bins < fewest:
            best, fewest = [(one.times, one.filling) for one in levels], bins
    return best
