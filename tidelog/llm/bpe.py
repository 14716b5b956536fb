"""Byte-level BPE with a two-tier lookup.

Whole pre-tokens that the vocabulary holds are found through a minimal perfect hash: as
many slots as tokens, one hash, one displacement, one comparison. The rest are merged
over a linked list of their bytes, the next merge taken from a heap.

A batch's bytes are first cut at white space into chunks that lie side by side, which the
pre-token pattern never crosses, and each distinct chunk is encoded once.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.pieces import Pieces

SCHEMA = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

#: White space as the rank files' library knows it (the Unicode property): fixed values.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A text with any of these is cut by the pattern as a whole.
WIDE_WHITE = regex.compile(rf"[{WHITE}--[\t-\r ]]", regex.V1)


class PerfectHash:
    """A minimal perfect hash of byte strings to their places in ``keys``.

    Keys fall into buckets by one hash; each bucket, largest first, gets the first
    displacement that sends its keys to free slots.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size // 2)
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot = np.full(self.size, -1, np.int64)
        self.keys = keys
        hashes = [xxhash.xxh3_128_intdigest(key) for key in keys]
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for place, found in enumerate(hashes):
            members[(found >> 96) % self.buckets].append(place)
        taken = bytearray(self.size)
        free = self.size
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            mine = members[bucket]
            if not mine:
                break
            if len(mine) == 1 and free:  # any free slot will do
                free = taken.rfind(0, 0, free)
                self.shift[bucket] = -1 - free
                taken[free] = 1
                self.slot[free] = mine[0]
                continue
            shift = 0
            while True:
                goals = [self._goal(hashes[place], shift) for place in mine]
                if len(set(goals)) == len(goals) and not any(taken[g] for g in goals):
                    break
                shift += 1
            self.shift[bucket] = shift
            for place, goal in zip(mine, goals, strict=True):
                taken[goal] = 1
                self.slot[goal] = place
        self.shifts, self.slots = self.shift.tolist(), self.slot.tolist()

    def _goal(self, found: int, shift: int) -> int:
        base, step = found & 0xFFFFFFFF, (found >> 32) & 0xFFFFFFFF
        return (base + shift * (step | 1) + shift * shift) % self.size

    def place(self, key: bytes) -> int:
        """The key's place, or -1."""
        if not self.size:
            return -1
        found = xxhash.xxh3_128_intdigest(key)
        shift = self.shifts[(found >> 96) % self.buckets]
        place = self.slots[-1 - shift if shift < 0 else self._goal(found, shift)]
        return place if self.keys[place] == key else -1


class Coder:
    """Encodes and decodes by a file of ranks (lines of a token in base 64 and its rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            parts = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in parts}
        self.tokens = list(self.ranks)
        self.values = [self.ranks[token] for token in self.tokens]
        self.whole = PerfectHash(self.tokens)
        self.pattern = regex.compile(
            pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{WHITE}\p{{L}}\p{{N}}]")
            .replace(r"\s", rf"[{WHITE}]")
            .replace(r"\S", rf"[^{WHITE}]")
        )
        self.of_two = [self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.known: dict[str, list[int]] = {}
        self.pieces = Pieces(self.encode_chunks, 72 << 20)
        size = max(self.values, default=-1) + 1
        lengths = np.zeros(size, np.int64)
        by_rank = sorted((rank, token) for token, rank in self.ranks.items())
        for rank, token in by_rank:
            lengths[rank] = len(token)
        self.token_count = lengths
        self.token_start = np.cumsum(lengths) - lengths
        self.token_bytes = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """Ids of bytes that are no token: pairs merge by lowest rank, leftmost first."""
        get, size = self.ranks.get, len(data)
        stop = list(range(1, size + 1))  # of the part that begins at a byte
        before = list(range(-1, size - 1))  # the part to the left
        of_two = self.of_two
        pair = [of_two[a << 8 | b] for a, b in zip(data, data[1:], strict=False)]
        pair.append(-1)  # the rank of a part and the part to its right
        heap = [rank * size + i for i, rank in enumerate(pair) if rank >= 0]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), size)
            if pair[i] != rank:
                continue  # it went into another merge
            j = stop[i]
            end = stop[i] = stop[j]
            pair[j] = rank = -1
            if end < size:
                before[end] = i
                rank = get(data[i : stop[end]], -1)
                if rank >= 0:
                    heappush(heap, rank * size + i)
            pair[i] = rank
            left = before[i]
            if left >= 0:
                rank = pair[left] = get(data[left:end], -1)
                if rank >= 0:
                    heappush(heap, rank * size + left)
        ids, i = [], 0
        while i < size:
            ids.append(get(data[i : stop[i]]))
            i = stop[i]
        return ids

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        ids = self.known.get(piece)
        if ids is None:
            data = piece.encode()
            place = self.whole.place(data)
            ids = [self.values[place]] if place >= 0 else self.merged(data)
            if len(self.known) >= 300_000:
                self.known.clear()
            if len(data) <= 64:
                self.known[piece] = ids
        return ids

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        find, encode = self.pattern.findall, self.encode_piece
        found = []
        for chunk in chunks:
            pieces = find(chunk.decode())
            if len(pieces) == 1:
                found.append(encode(pieces[0]))
            else:
                found.append([i for piece in pieces for i in encode(piece)])
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each text."""
        offsets, owner = _chunks(texts)
        _, data = T.buffers(texts)
        codes, distinct = T.coded(T.strings(offsets, data))
        ids, counts = self.pieces.ids(codes, distinct)
        totals = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        return ids, totals

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        return self.token_bytes[T.flat_ranges(self.token_start[ids], self.token_count[ids])]


def _chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of chunks that cover all texts, and the text of each chunk.

    Of white space before other bytes, the last byte is parted from the rest; a space there
    goes with what follows. A text with white space outside ASCII is one chunk.
    """
    ends, data = T.buffers(texts)
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(0, np.int64)
    space = T.SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    opens = np.flatnonzero(~space[1:] & space[:-1] & ~edge[1:-1]) + 1  # word after white space
    cut[opens - 1] = True
    other = opens[data[opens - 1] != 32]
    cut[other] = True
    cut[1:-1] |= space[1:] & ~space[:-1]  # white space after a word
    wide = np.isin(data, (0xC2, 0xE1, 0xE2, 0xE3))
    for row in np.flatnonzero(T.per_text(ends, wide)):
        if WIDE_WHITE.search(texts[int(row)].as_py()):
            cut[ends[row] : ends[row + 1]] = False
    cut |= edge
    offsets = np.flatnonzero(cut)
    owner = np.searchsorted(ends, offsets[:-1], "right") - 1
    return offsets, owner


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _digests(path: str, pattern: str, texts: pa.Array) -> list[pa.Array]:
    own = coder(path, pattern)
    ids, totals = own.encode(texts)
    wire = ids.astype("<u4")
    decoded = own.decode(ids)
    id_ends = np.append(0, np.cumsum(totals))
    byte_run = np.append(0, np.cumsum(own.token_count[ids]))
    byte_ends = byte_run[id_ends]
    sha = hashlib.sha256
    return [
        pa.array(totals, pa.int64()),
        pa.array([sha(wire[a:b]).hexdigest() for a, b in zip(id_ends[:-1], id_ends[1:], strict=True)], pa.string()),
        pa.array([sha(decoded[a:b]).hexdigest() for a, b in zip(byte_ends[:-1], byte_ends[1:], strict=True)], pa.string()),
    ]


def digests(text: Column, path: str, pattern: str) -> Column:
    """A struct of the number of ids, a digest of the ids and one of the decoded bytes."""

    @F.arrow_udf(SCHEMA)
    def digest(values: pa.Array) -> pa.Array:
        parts = [_digests(path, pattern, part) for _, part in T.slices(T.plain(values))]
        names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]
        if not parts:
            return pa.array([], pa.struct([("n_tokens", pa.int64()), *((n, pa.string()) for n in names[1:])]))
        return pa.StructArray.from_arrays([pa.concat_arrays(c) for c in zip(*parts, strict=True)], names)

    return digest(text)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """The ids of ``text`` as an array (null: no ids)."""

    @F.arrow_udf("array<int>")
    def encode(values: pa.Array) -> pa.Array:
        own = coder(path, pattern)
        parts = []
        for _, part in T.slices(T.plain(values)):
            ids, totals = own.encode(part)
            offsets = np.append(0, np.cumsum(totals)).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of an array of ids (null: null)."""

    @F.arrow_udf("binary")
    def decode(values: pa.Array) -> pa.Array:
        own = coder(path, pattern)
        return pa.array(
            [None if one is None else own.decode(np.array(one, np.int64)).tobytes() for one in values.to_pylist()],
            pa.binary(),
        )

    return decode(ids)


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, number of ids, digests of the ids and of the decoded bytes.

    A null text counts as empty: no ids, the digests of no bytes. Texts of any length are
    encoded whole; strings of special tokens are ordinary text. Repeated rows give repeated
    rows; other columns play no part.
    """
    found = docs.select(id_col, digests(F.col(text), path, pattern).alias("_digests"))
    return found.select(id_col, "_digests.*")
