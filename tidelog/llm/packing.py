"""Packing of tokenised documents into sequences of equal room, with the fewest sequences.

Tokens are counted in Spark; the number of pieces of each length, a table of at most as
many rows as a sequence has tokens, is all that the packing search sees (see ``binpack``).
Its fillings are then given out: the pieces of a length are numbered, and each number has
its place in some sequence.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.binpack import pack
from tidelog.llm.frames import ranked, written_table
from tidelog.llm.pieces import Pieces, flattened, held

if TYPE_CHECKING:
    from tokenizers import Tokenizer

ROOM, SEPARATOR = 2048, 0
#: Bytes of texts that are encoded at a time.
SLICE_BYTES = 1 << 20
#: Strings that are encoded as one text, with a mark after each: white space parts them.
RUN_STRINGS = 128
#: Rows that one ranking task takes.
RANK_ROWS = 200_000
PIECE = "array<struct<piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>>>"

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _vocabulary(path: str) -> Pieces:
    return held(("packing", path), lambda: _pieces(path))


def _pieces(path: str) -> Pieces:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    model, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    model.encode_special_tokens = plain.encode_special_tokens = True  # their strings in a text are ordinary text
    plain.normalizer, plain.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()  # what lower letters need
    mark, mark_id = _mark(model)
    between = f" {mark} "

    def in_runs(by: Tokenizer, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        runs = [words[at : at + RUN_STRINGS] for at in range(0, len(words), RUN_STRINGS)]
        found = by.encode_batch_fast([between.join(run) + between for run in runs], add_special_tokens=False)
        for one, run in zip(found, runs, strict=True):
            parts = _parted(np.array(one.ids, np.int32), len(run), mark_id)
            yield parts or flattened([w.ids for w in by.encode_batch_fast(run, add_special_tokens=False)])

    def encode(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        is_plain = np.fromiter((v.isalpha() and v.islower() for v in values), bool, len(values))
        words = [v.decode() for v in values]
        parts = []
        for by, some in ((plain, is_plain), (model, ~is_plain)):
            parts += in_runs(by, list(compress(words, some.tolist())))
        ids, counts = (np.concatenate(both) for both in zip(*parts, strict=True))
        place = np.empty(len(values), np.int64)
        place[np.argsort(~is_plain, kind="stable")] = np.arange(len(values))
        return ids[T.flat_ranges((np.cumsum(counts) - counts)[place], counts[place])], counts[place]

    return Pieces(encode)


def _mark(model: Tokenizer) -> tuple[str, int]:
    """A word that is one id by itself, the last one learned of plain letters, and its id."""
    plain = ((number, word.removesuffix("</w>")) for word, number in model.get_vocab().items() if word.endswith("</w>"))
    for number, word in sorted(plain, reverse=True):
        if re.fullmatch("[a-z]+", word) and model.encode(word, add_special_tokens=False).ids == [number]:
            return word, number
    raise ValueError("the vocabulary has no word of plain letters")


def _parted(ids: np.ndarray, count: int, mark_id: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids without marks, and how many each string has; None if a string holds the mark itself."""
    is_mark = ids == mark_id
    ends = np.flatnonzero(is_mark)
    if len(ends) != count:
        return None
    return ids[~is_mark], np.diff(ends, prepend=-1) - 1


def token_ids(texts: pa.Array, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the number of ids of each text.

    The vocabulary lowers case, drops white space and ends its pre-tokens where a letter is
    followed by ASCII that is none, so the parts between can be encoded by themselves. Case
    is lowered beforehand only where ASCII follows: elsewhere a mark could join the letter.
    """
    found = T.words(texts)
    data = found.data
    after = np.append(data[1:], np.uint8(32))
    data = np.where(after < 0x80, LOWER[data], data).astype(np.uint8)
    cuts = np.flatnonzero(LETTER[data[:-1]] & ~LETTER[data[1:]] & ~T.SPACE[data[1:]] & (data[1:] < 0x80)) + 1
    inside = ~T.SPACE[data]
    starts = np.zeros(len(data), bool)
    starts[found.start] = True
    starts[cuts] = True
    starts = np.flatnonzero(starts)
    place = np.append(np.int32(0), np.cumsum(inside, dtype=np.int32))
    offsets = np.append(place[starts], place[-1])
    codes, distinct = T.coded(T.strings(offsets, data[inside]))
    ids, counts = _vocabulary(vocabulary).ids(codes, distinct)
    owner = np.searchsorted(found.ends, starts, "right") - 1
    return ids, np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)


def _cut(texts: pa.Array, vocabulary: str, room: int, with_ids: bool) -> list[list[dict]]:
    ids, totals = token_ids(texts, vocabulary)
    sizes = totals + 1
    ends = np.append(0, np.cumsum(sizes))
    out = np.full(int(ends[-1]), SEPARATOR, np.uint32)
    out[T.flat_ranges(ends[:-1], totals)] = ids
    wire = out.astype("<u4")
    rows = []
    for begin, size in zip(ends[:-1].tolist(), sizes.tolist(), strict=True):
        pieces = []
        for number, start in enumerate(range(0, size, room)):
            length = min(room, size - start)
            part = wire[begin + start : begin + start + length]
            pieces.append(
                {
                    "piece": number,
                    "start": start,
                    "length": length,
                    "ids_crc32": zlib.crc32(part),
                    "ids": part.tolist() if with_ids else None,
                }
            )
        rows.append(pieces)
    return rows


def cut_pieces(text: Column, vocabulary: str, room: int = ROOM, with_ids: bool = False) -> Column:
    """An array of pieces: the ids of ``text`` and a separator, cut where a sequence is full."""
    kind = pa.list_(
        pa.struct(
            [
                ("piece", pa.int32()),
                ("start", pa.int64()),
                ("length", pa.int64()),
                ("ids_crc32", pa.int64()),
                ("ids", pa.list_(pa.int32())),
            ]
        )
    )

    @F.arrow_udf(PIECE)
    def cut(values: pa.Array) -> pa.Array:
        parts = [pa.array(_cut(part, vocabulary, room, with_ids), kind) for _, part in T.slices(T.plain(values), SLICE_BYTES)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return cut(text)


def _places(counts: np.ndarray) -> dict[str, np.ndarray]:
    """For runs of piece numbers of a length: where they go. At most 63 sizes share a filling."""
    next_number = np.zeros(len(counts), np.int64)
    rows, sequence = [], 0
    for bins, filling in pack(counts):
        offset = 0
        for size, times in filling:
            rows.append((size, int(next_number[size]), sequence, offset, times))
            next_number[size] += bins * times
            offset += size * times
        sequence += bins
    rows.sort()
    names = ("length", "first", "sequence", "offset", "times")
    columns = np.array(rows, np.int64).reshape(-1, len(names)).T
    return dict(zip(names, columns, strict=True))


def _placed(length: Column, number: Column, places: dict[str, np.ndarray]) -> Column:
    @F.arrow_udf("sequence_id bigint, offset bigint")
    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        size, rank = (v.to_numpy(zero_copy_only=False).astype(np.int64) for v in (lengths, numbers))
        shift = np.int64(1) << np.int64(44)
        at = np.searchsorted(places["length"] * shift + places["first"], size * shift + rank, "right") - 1
        turn = rank - places["first"][at]
        times = places["times"][at]
        return pa.StructArray.from_arrays(
            [
                pa.array(places["sequence"][at] + turn // times),
                pa.array(places["offset"][at] + turn % times * size),
            ],
            ["sequence_id", "offset"],
        )

    return place(length, number)


def packed(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text: str = "text",
    room: int = ROOM,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A null or empty text is one piece that holds the separator alone. Texts are encoded
    whole; only those longer than ``room`` are cut. Repeated rows are packed as often as they
    occur; columns other than id and text play no part; an empty table gives an empty table.
    """
    found = docs.select(F.col(id_col).alias("id_"), F.explode(cut_pieces(F.col(text), vocabulary, room, with_ids)).alias("p"))
    columns = ["piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    stored = written_table(found.select("id_", *[f"p.{c}" for c in columns]), "pieces")
    counts = np.zeros(room + 1, np.int64)
    for row in stored.groupBy("length").count().collect():  # at most ``room`` rows
        counts[row["length"]] = row["count"]
    places = _places(counts)
    parts = 16 + int(counts.sum()) // RANK_ROWS
    spread = F.pmod(F.xxhash64("id_", "piece", "ids_crc32"), F.lit(parts))
    order = [F.col("id_"), F.col("piece"), F.col("ids_crc32")]
    numbered = ranked(stored, ["length"], order, spread, parts, "number_")
    placed = numbered.withColumn("place_", _placed(F.col("length"), F.col("number_"), places))
    return placed.select(F.col("id_").alias(id_col), *columns, "place_.sequence_id", "place_.offset")
