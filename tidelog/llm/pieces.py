"""What a worker process keeps: one operator's resources, and the token ids of many strings.

Worker processes serve one operator after another, so what one of them leaves behind would
add up. A process holds the resources of the operator at work only (see ``held``), and
remembers strings up to a number of bytes.
"""

from __future__ import annotations

import ctypes
import gc
import weakref
from collections.abc import Callable, Hashable
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa

from tidelog.llm.texts import flat_ranges

_ALL: weakref.WeakSet[Pieces] = weakref.WeakSet()
_HELD: dict[Hashable, Any] = {}


def _give_back() -> None:
    """Hands freed memory back to the machine, as far as the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept until another operator of this process asks for something else."""
    if key not in _HELD:
        forget()
        _HELD[key] = make()
    return _HELD[key]


def forget(but: Pieces | None = None) -> None:
    """Drops what other operators hold and remember in this process."""
    others = [pieces for pieces in _ALL if pieces is not but and pieces.number]
    for pieces in others:
        pieces.clear()
    if but is None and _HELD:
        _HELD.clear()
        others = others or [None]
    if others:
        _give_back()


class Pieces:
    """Remembers the ids of strings; beyond ``most`` bytes it starts anew.

    ``encode`` takes a list of distinct byte strings and gives a list of ids for each, or all
    ids one after another and how many each string has.
    Memory is bounded by ``most`` and by the distinct strings of one slice.
    """

    def __init__(
        self, encode: Callable[[list[bytes]], list[list[int]] | tuple[np.ndarray, np.ndarray]], most: int = 48 << 20
    ):
        self.encode, self.most = encode, most
        self.clear()
        _ALL.add(self)

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.count = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.int32)
        self.used = 0
        self.size = 0

    def _add(self, values: list[bytes]) -> None:
        found = self.encode(values)
        ids, counts = found if isinstance(found, tuple) else flattened(found)
        at = len(self.number)
        self.start = _room(self.start, at + len(values))
        self.count = _room(self.count, at + len(values))
        self.pool = _room(self.pool, self.used + len(ids))
        self.start[at : at + len(values)] = self.used + np.cumsum(counts) - counts
        self.count[at : at + len(values)] = counts
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.size += _bytes(values) + 4 * len(ids)
        self.number.update(zip(values, range(at, at + len(values)), strict=True))

    def ids(self, codes: np.ndarray, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings one after another, and how many each string has."""
        forget(self)
        values = distinct.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.number.get, values, repeat(-1)), np.int64, len(values))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [values[i] for i in missing.tolist()]
            if self.number and self.size + _bytes(new) > self.most:
                self.clear()
                missing, new = np.arange(len(values)), values
            at[missing] = np.arange(len(self.number), len(self.number) + len(new))
            self._add(new)
        counts = self.count[at][codes]
        return self.pool[flat_ranges(self.start[at][codes], counts)], counts


def flattened(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and how many each list has."""
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for one in found for i in one), np.int32, int(counts.sum())), counts


def _bytes(values: list[bytes]) -> int:
    """About what strings take as keys: their bytes, an object, an entry and two numbers each."""
    return sum(map(len, values)) + 160 * len(values)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown
