"""Words, lines and spans of a batch of texts as flat arrays.

The texts of an Arrow batch are taken as one run of UTF-8 bytes. Everything that is
per word or per character is then a few array operations for the whole batch instead
of a Python loop. Batches are worked on in slices of bounded bytes, so memory follows
the slice (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

#: Which bytes part words: space and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Which bytes continue a code point.
CONTINUES = np.zeros(256, bool)
CONTINUES[0x80:0xC0] = True


def plain(array: pa.Array) -> pa.Array:
    """The texts as one large-string array without nulls."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return pc.fill_null(array.cast(pa.large_string()), "")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (one more than texts, from 0) and bytes of a large-string array."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return ends - ends[0], np.zeros(0, np.uint8)
    return ends - ends[0], np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of at most ``most`` bytes, or of one longer text."""
    ends, _ = buffers(texts)
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(ends, ends[at] + most, "right")) - 1
        stop = min(max(stop, at + 1), len(texts))
        yield at, texts.slice(at, stop - at)
        at = stop


def strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """A large-binary array over bytes that lie side by side."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))],
    )


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each value (equal values, equal numbers), and the distinct values."""
    found = values.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def per_text(ends: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    some = np.flatnonzero(ends[1:] > ends[:-1])
    counts = np.zeros(len(ends) - 1, np.int64)
    if len(some):
        counts[some] = np.add.reduceat(marks, ends[:-1][some], dtype=np.int64)
    return counts


@dataclass
class Words:
    """Maximal runs of bytes other than space and control characters 9 to 13."""

    ends: np.ndarray  #: byte offsets of the texts
    data: np.ndarray  #: bytes of the texts
    start: np.ndarray  #: first byte of each word
    stop: np.ndarray  #: byte after each word
    text: np.ndarray  #: which text each word belongs to
    first: np.ndarray  #: number of the first word of each text; one more entry than texts

    def values(self) -> pa.Array:
        offsets = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.stop - self.start, out=offsets[1:])
        return strings(offsets, self.data[~SPACE[self.data]])


def words(texts: pa.Array) -> Words:
    ends, data = buffers(texts)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    begins[edges] = inside[edges]  # a text begins anew
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = edges[edges > 0] - 1
    stops[last] = inside[last]
    if len(data):
        stops[-1] = inside[-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(start, ends)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(first))
    return Words(ends, data, start, stop, text, first)


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte offset, how many code points begin before it."""
    run = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~CONTINUES[data], out=run[1:])
    return run


def repeated_words(found: Words, codes: np.ndarray, width: int = 8) -> np.ndarray:
    """Which words lie in a window of ``width`` words that its text has twice.

    Windows with equal hashes are compared word by word.
    """
    marked = np.zeros(len(codes), bool)
    per = np.maximum(np.diff(found.first) - width + 1, 0)
    at = flat_ranges(found.first[:-1], per)
    if not len(at):
        return marked
    key = np.repeat(mixed(np.arange(len(per))), per)
    word = mixed(codes)
    for k in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + word[at + k]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return marked
    near = np.searchsorted(twice, key)
    again = twice[np.minimum(near, len(twice) - 1)] == key
    at, key = at[again], key[again]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    text = found.text[at]
    run = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    head = at[np.searchsorted(run, np.arange(run[-1] + 1))][run]
    same = found.text[head] == text
    for k in range(width):
        same &= codes[at + k] == codes[head + k]
    if not same.all():  # a hash that two windows share: number windows by their words
        rows = np.stack([text, *(codes[at + k] for k in range(width))], axis=1)
        _, group, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        at = at[times[group.ravel()] > 1]
    edge = np.bincount(at, minlength=len(codes) + 1) - np.bincount(
        at + width, minlength=len(codes) + 1
    )
    return np.cumsum(edge[:-1]) > 0


def mixed(numbers: np.ndarray) -> np.ndarray:
    """64 well-spread bits for each number (the finish of SplitMix64)."""
    z = numbers.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each line with a word: its text, a number (equal lines, equal numbers), its start.

    Lines end at a line feed, which belongs to no line.
    """
    ends, data = buffers(texts)
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([ends[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(ends) - 1), np.searchsorted(ends, breaks, "right") - 1])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    stop = np.empty(len(start), np.int64)
    stop[:-1] = start[1:] - (text[1:] == text[:-1])
    stop[-1:] = len(data)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=offsets[1:])
    codes, _ = coded(strings(offsets, data[data != 10]))
    run = np.zeros(len(data) + 1, np.int32)  # a text has less than 2**31 bytes
    np.cumsum(~SPACE[data], out=run[1:])
    wordy = run[stop] > run[start]
    return text[wordy], codes[wordy], start[wordy]


def flat_ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), then the same for each next entry."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(count) - count
    return np.arange(total) + np.repeat(start - before, count)
