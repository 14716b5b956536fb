"""Alignment of two tokenizers' ids over a corpus, with an identity-map fast path.

A text is cut where both tokenizers' tokens end; tokens of a cut part belong together. Neither
joins a word to the white space after it, so a text is a row of chunks (a space or line feed
after anything else begins one) and each distinct chunk is aligned once.

An array tells for each id of A the id of B with the same bytes. Pairs of that kind are counted
in a vector as long as A's vocabulary; only the other pairs, from irregular parts, are
shuffled, as sums over blocks of documents. Blocks then learn the totals of their own pairs, so
what returns to documents is a row per block and distinct pair, not per document and pair.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.bpe import WIDE_WHITE
from tidelog.llm.frames import written_table
from tidelog.llm.pieces import forget

SLICE_BYTES = 1 << 20
#: A block of documents ends after so many bytes of text.
BLOCK_BYTES = 16 << 20
#: What a process remembers of chunks, beyond those of one slice.
KNOWN_BYTES = 64 << 20
#: Pairs that are listed at a time.
PAIRS = 1 << 20

PREFIX = pa.scalar(" ", pa.large_string())


def byte_alphabet() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes, in order, for
    the characters from U+0100 on.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The bytes of every id, and how many they are."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.count = np.fromiter(map(len, tokens), np.int64, len(tokens))


class Aligner:
    """Aligns chunks, each distinct one once as long as it is remembered.

    A chunk's links are kept as references with the number of times each occurs: -1 - a for the
    pair of an id ``a`` of A with the id of B of the same bytes, else the number of a pair.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a_model = Tokenizer.from_file(a_path)
        self.a_model.encode_special_tokens = True  # their strings in a text are ordinary text
        byte_of = byte_alphabet()
        size = self.a_model.get_vocab_size(with_added_tokens=True)
        names = [self.a_model.id_to_token(i) or "" for i in range(size)]
        self.a = Vocabulary(
            [bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode() for name in names]
        )
        self.b_model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        count = self.b_model.GetPieceSize()
        raw = [self.b_model.IsByte(i) for i in range(count)]
        shown = [self.b_model.IdToPiece(i) for i in range(count)]
        self.b = Vocabulary(
            [bytes([int(p[3:5], 16)]) if r else p.replace("▁", " ").encode() for p, r in zip(shown, raw, strict=True)]
        )
        self.space = self.b_model.PieceToId("▁")
        of_bytes = {token: i for i, token in enumerate(self.b.tokens) if raw[i]}
        of_bytes |= {
            token: i for i, token in enumerate(self.b.tokens)
            if not (raw[i] or self.b_model.IsControl(i) or self.b_model.IsUnknown(i))
        }
        #: For each id of A the id of B with the same bytes, or -1.
        self.same = np.array([of_bytes.get(token, -1) for token in self.a.tokens], np.int64)
        self.pair: dict[int, int] = {}
        self.forget()

    def forget(self) -> None:
        """Forgets the chunks. The numbers of pairs stay: a block's documents refer to them."""
        self.number: dict[bytes, int] = {}
        self.shown: list[bytes] = []
        self.size = 0
        #: tokens of A and B, groups and links of each chunk; a chunk that is not its tokens' bytes is bad
        self.counts = np.zeros((1024, 4), np.int64)
        self.bad = np.zeros(1024, bool)
        self.first = np.zeros(1024, np.int64)
        self.many = np.zeros(1024, np.int64)
        self.refs = np.zeros(4096, np.int64)
        self.times = np.zeros(4096, np.int64)
        self.used = 0

    def remembered(self) -> int:
        """About how many bytes."""
        return self.size + 200 * len(self.number) + 16 * self.used

    def _ids(self, chunks: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        strings = [chunk.decode() for chunk in chunks]
        found_a = [one.ids for one in self.a_model.encode_batch_fast(strings, add_special_tokens=False)]
        # the model puts a space before each text, which here is the chunk's own or, before a
        # line feed, a token of its own
        found_b = self.b_model.encode([s[1:] if s[0] == " " else s for s in strings], num_threads=1)
        for i, string in enumerate(strings):
            if string == " ":
                found_b[i] = [self.space]
            elif string[0] != " ":
                found_b[i] = found_b[i][1:]
        return found_a, found_b

    def _flat(self, found: list[list[int]], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids one after another, tokens of each chunk, and bytes of each chunk."""
        many = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for one in found for i in one), np.int64, int(many.sum()))
        edges = np.append(0, np.cumsum(vocabulary.count[ids]))
        ends = np.append(0, np.cumsum(many))
        return ids, many, edges[ends[1:]] - edges[ends[:-1]]

    def _add(self, chunks: list[bytes]) -> None:
        found_a, found_b = self._ids(chunks)
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        _, _, bytes_a = self._flat(found_a, self.a)
        _, _, bytes_b = self._flat(found_b, self.b)
        bad = (bytes_a != length) | (bytes_b != length)
        for i in np.flatnonzero(~bad).tolist():
            text = chunks[i]
            bad[i] = (
                b"".join([self.a.tokens[t] for t in found_a[i]]) != text
                or b"".join([self.b.tokens[t] for t in found_b[i]]) != text
            )
        for i in np.flatnonzero(bad).tolist():
            found_a[i], found_b[i] = [], []
        ids_a, many_a, _ = self._flat(found_a, self.a)
        ids_b, many_b, _ = self._flat(found_b, self.b)
        ends_a, ends_b = np.cumsum(self.a.count[ids_a]), np.cumsum(self.b.count[ids_b])
        size = int(ends_a[-1]) if len(ends_a) else 0
        is_end = np.zeros(size + 1, bool)
        is_end[ends_a] = True
        cut_b = is_end[ends_b]
        is_end[:] = False
        is_end[ends_b] = True
        cut_a = is_end[ends_a]
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        groups = int(cut_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        chunk_a = np.repeat(np.arange(len(chunks)), many_a)
        owner = chunk_a[cut_a]  # of each group
        n_groups = np.bincount(owner, minlength=len(chunks))
        n_links = np.zeros(len(chunks), np.int64)
        np.add.at(n_links, owner, in_a * in_b)

        at = len(self.number)
        self.counts, self.bad, self.first, self.many = (
            _room(array, at + len(chunks)) for array in (self.counts, self.bad, self.first, self.many)
        )
        new = slice(at, at + len(chunks))
        self.counts[new] = np.stack([many_a, many_b, n_groups, n_links], axis=1)
        self.bad[new] = bad
        refs, times, per = self._links(ids_a, ids_b, group_a, group_b, owner, len(chunks))
        self.refs, self.times = (_room(array, self.used + len(refs)) for array in (self.refs, self.times))
        self.refs[self.used : self.used + len(refs)] = refs
        self.times[self.used : self.used + len(refs)] = times
        self.first[new] = self.used + np.cumsum(per) - per
        self.many[new] = per
        self.used += len(refs)
        shown = _shown(ids_a, ids_b, in_a, in_b, n_groups)
        self.shown += shown
        self.size += int(length.sum()) + sum(map(len, shown))
        self.number.update(zip(chunks, range(at, at + len(chunks)), strict=True))

    def _links(self, ids_a, ids_b, group_a, group_b, owner, chunks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """References and their times, chunk by chunk, and how many each chunk has."""
        wide = len(self.b.tokens)
        # distinct ids of each group on either side, and how often each occurs there
        key_a, times_a = np.unique(group_a * len(self.a.tokens) + ids_a, return_counts=True)
        key_b, times_b = np.unique(group_b * wide + ids_b, return_counts=True)
        a_group, a_id = np.divmod(key_a, len(self.a.tokens))
        b_group, b_id = np.divmod(key_b, wide)
        groups = np.arange(len(owner) + 1)
        first_b = np.searchsorted(b_group, groups)
        fan = np.diff(first_b)[a_group]
        edges = np.append(0, np.cumsum(fan))
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        done = 0
        while done < len(a_id):  # an id of A at least, with all ids of B that share its group
            stop = max(done + 1, int(np.searchsorted(edges, edges[done] + PAIRS, "right")) - 1)
            rows = np.repeat(np.arange(done, stop), fan[done:stop])
            other = T.flat_ranges(first_b[a_group[done:stop]], fan[done:stop])
            a, b = a_id[rows], b_id[other]
            # a pair of ids with the same bytes is told by the id of A alone
            kind = np.where(self.same[a] == b, a, len(self.same) + a * wide + b)
            chunk = owner[a_group[rows]]
            parts.append(_summed(chunk, kind, times_a[rows] * times_b[other]))
            done = stop
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(chunks, np.int64)
        chunk, kind, times = (np.concatenate(c) for c in zip(*parts, strict=True))
        if len(parts) > 1:
            chunk, kind, times = _summed(chunk, kind, times)
        refs = -1 - kind
        others = np.flatnonzero(kind >= len(self.same))
        keys = kind[others] - len(self.same)
        distinct, turn = np.unique(keys, return_inverse=True)
        numbers = [self.pair.setdefault(key, len(self.pair)) for key in distinct.tolist()]
        refs[others] = np.array(numbers, np.int64)[turn]
        return refs, times, np.bincount(chunk, minlength=chunks)

    def numbers(self, codes: np.ndarray, distinct: pa.Array) -> np.ndarray:
        """The number of each chunk."""
        values = distinct.to_pylist()
        at = list(map(self.number.get, values))
        missing = [value for value, known in zip(values, at, strict=True) if known is None]
        if missing:
            self._add(missing)
            at = list(map(self.number.get, values))
        return np.array(at, np.int64)[codes]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros((max(size, 2 * len(array)), *array.shape[1:]), array.dtype)
    grown[: len(array)] = array
    return grown


def _summed(chunk: np.ndarray, kind: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal chunk and kind as one, their times added; sorted."""
    order = np.lexsort((kind, chunk))
    chunk, kind, times = chunk[order], kind[order], times[order]
    heads = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1]))[: len(chunk)])
    return chunk[heads], kind[heads], np.add.reduceat(times, heads) if len(heads) else times


def _shown(ids_a, ids_b, in_a, in_b, n_groups) -> list[bytes]:
    """For each chunk its groups as ``a1,a2|b1;a3|b2``."""
    a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    groups, at_a, at_b = [], 0, 0
    for m, n in zip(in_a.tolist(), in_b.tolist(), strict=True):
        if m == n == 1:
            groups.append(f"{a[at_a]}|{b[at_b]}")
        else:
            groups.append(f"{','.join(a[at_a : at_a + m])}|{','.join(b[at_b : at_b + n])}")
        at_a += m
        at_b += n
    found, at = [], 0
    for n in n_groups.tolist():
        found.append(";".join(groups[at : at + n]).encode())
        at += n
    return found


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, where chunks begin (one entry more), and the text of each chunk.

    Texts are not empty. A chunk begins with its text and at each space or line feed after a
    byte that is none of white space; next to white space beyond ASCII none begins.
    """
    ends, data = T.buffers(texts)
    white = T.SPACE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[1:-1] = ((data[1:] == 32) | (data[1:] == 10)) & ~white[:-1]
    wide = np.isin(data, (0xC2, 0xE1, 0xE2, 0xE3))
    for row in np.flatnonzero(T.per_text(ends, wide)).tolist():
        if WIDE_WHITE.search(texts[row].as_py()):
            begin, end = int(ends[row]), int(ends[row + 1])
            opens[begin + 1 : end] &= data[begin : end - 1] < 0x80
    opens[ends] = True
    offsets = np.flatnonzero(opens)
    return data, offsets, np.searchsorted(ends, offsets[:-1], "right") - 1


#: One row per document (kind document), then rows of the block: a pair and its number, an id of A. ``once``
#: are the references of the document that occur once, ``refs`` and ``times`` the others.
BLOCK = (
    "block bigint, kind string, id_ {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, once array<int>, refs array<int>, times array<bigint>, number int, a int, b int, n bigint"
)


class _Block:
    """Documents of one block, and by reference how many of them hold it."""

    def __init__(self, own: Aligner, number: int):
        self.own, self.number, self.bytes = own, number, 0
        self.same = np.zeros(len(own.same), np.int64)
        self.pairs = np.zeros(1024, np.int64)

    def documents(self, ids: pa.Array, texts: pa.Array) -> dict[str, pa.Array]:
        """The rows of the documents of a slice (null texts: empty)."""
        own, n = self.own, len(texts)
        some = np.flatnonzero(pc.binary_length(texts).to_numpy() > 0)
        counts = np.zeros((n, 4), np.int64)
        digests = [""] * n
        text, refs, times = (np.zeros(0, np.int64) for _ in range(3))
        if len(some):
            led = pc.binary_join_element_wise(PREFIX, texts.take(pa.array(some)), pa.scalar("", pa.large_string()))
            data, offsets, owner = chunks(led)
            which, distinct = T.coded(T.strings(offsets, data))
            number = own.numbers(which, distinct)
            spoiled = np.zeros(len(some), bool)
            spoiled[owner[own.bad[number]]] = True
            number, owner = number[~spoiled[owner]], owner[~spoiled[owner]]
            first = np.searchsorted(owner, np.arange(len(some) + 1))
            run = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(own.counts[number], axis=0)])
            counts[some] = run[first[1:]] - run[first[:-1]]
            shown, listed = own.shown, number.tolist()
            for row, a, b in zip(some.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                if b > a:
                    digests[row] = hashlib.sha256(b";".join([shown[c] for c in listed[a:b]])).hexdigest()
            text, refs, times = self._references(owner, number)
            self._count(refs)
        many = times > 1
        lists = [np.bincount(some[text[side]], minlength=n) for side in (~many, many)] if len(some) else [np.zeros(n)] * 2
        once, more = (pa.array(np.append(0, np.cumsum(per)).astype(np.int32)) for per in lists)
        self.bytes += int(pc.sum(pc.binary_length(texts)).as_py() or 0)
        return {
            "kind": pa.array(["document"] * n, pa.string()),
            "id_": ids,
            **{name: pa.array(counts[:, k]) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "groups_sha256": pa.array(digests, pa.string()),
            "once": pa.ListArray.from_arrays(once, pa.array(refs[~many].astype(np.int32))),
            "refs": pa.ListArray.from_arrays(more, pa.array(refs[many].astype(np.int32))),
            "times": pa.ListArray.from_arrays(more, pa.array(times[many])),
        }

    def _references(self, owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, reference, times) of the texts' chunks, equal ones added up, in order."""
        own = self.own
        text, chunk = owner, number
        times = np.ones(len(text), np.int64)
        if len(text):
            key, times = np.unique(owner * len(own.number) + number, return_counts=True)
            text, chunk = np.divmod(key, len(own.number))
        many = own.many[chunk]
        at = T.flat_ranges(own.first[chunk], many)
        wide = len(own.same) + len(own.pair)
        key = np.repeat(text, many) * wide + own.refs[at] + len(own.same)
        key, times = _added(key, np.repeat(times, many) * own.times[at])
        text, ref = np.divmod(key, wide)
        return text, ref - len(own.same), times

    def _count(self, refs: np.ndarray) -> None:
        """Adds one document for each of its references."""
        own = self.own
        self.pairs = _room(self.pairs, len(own.pair))
        count = np.bincount(refs + len(own.same), minlength=len(own.same) + len(own.pair))
        self.same += count[: len(own.same)][::-1]  # reference -1 - a
        self.pairs[: len(own.pair)] += count[len(own.same) :]

    def totals(self) -> Iterator[dict[str, pa.Array]]:
        """The rows of the pairs and the ids of A that the block's documents hold."""
        own = self.own
        keys = np.fromiter(own.pair, np.int64, len(own.pair))
        held = np.flatnonzero(self.pairs[: len(keys)])
        a, b = np.divmod(keys[held], len(own.b.tokens))
        yield {
            "kind": pa.array(["pair"] * len(held), pa.string()),
            "number": pa.array(held.astype(np.int32)),
            "a": pa.array(a.astype(np.int32)),
            "b": pa.array(b.astype(np.int32)),
            "n": pa.array(self.pairs[held]),
        }
        a = np.flatnonzero(self.same)
        yield {"kind": pa.array(["same"] * len(a), pa.string()), "a": pa.array(a.astype(np.int32)), "n": pa.array(self.same[a])}


def _added(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the times of each."""
    if not len(key):
        return key, times
    if key.max() < 1 << 43 and times.max() < 1 << 20:  # one number holds both, and sorts faster
        both = np.sort(key << 20 | times)
        key, times = both >> 20, both & ((1 << 20) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[heads], np.add.reduceat(times, heads)


def blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str, text: str) -> DataFrame:
    """Documents in blocks, with what each block holds (see BLOCK)."""
    rows = docs.select(F.col(id_col).alias("id_"), F.col(text).alias("text_"))
    schema = BLOCK.format(id=rows.schema["id_"].dataType.simpleString())

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = aligner(a_path, b_path)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        block = None
        for batch in batches:
            ids, all_texts = (batch.column(batch.schema.get_field_index(n)) for n in ("id_", "text_"))
            for at, part in T.slices(T.plain(all_texts), SLICE_BYTES):
                if block is None:
                    own.pair.clear()
                    own.forget()
                    block = _Block(own, number)
                    number += 1
                elif own.remembered() > KNOWN_BYTES:
                    own.forget()
                yield _batch(block.documents(ids.slice(at, len(part)), part), block.number, ids.type)
                if block.bytes >= BLOCK_BYTES:
                    yield from (_batch(found, block.number, ids.type) for found in block.totals())
                    block = None
        if block is not None:
            yield from (_batch(found, block.number, ids.type) for found in block.totals())
        own.forget()

    return rows.mapInArrow(align, schema)


def _batch(found: dict[str, pa.Array], block: int, id_type: pa.DataType) -> pa.RecordBatch:
    """A record batch of BLOCK; columns that are not given are null."""
    kinds = {"id_": id_type, "groups_sha256": pa.string(), "times": pa.list_(pa.int64())}
    kinds |= {name: pa.int64() for name in ("n_a", "n_b", "n_groups", "n_links", "n")}
    kinds |= {name: pa.int32() for name in ("number", "a", "b")}
    kinds |= {name: pa.list_(pa.int32()) for name in ("once", "refs")}
    n = len(found["kind"])
    names = [part.strip().split(" ")[0] for part in BLOCK.split(",")]
    columns = {"block": pa.array(np.full(n, block, np.int64))} | found
    return pa.record_batch({name: columns[name] if name in columns else pa.nulls(n, kinds[name]) for name in names})


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, documents) of irregular pairs, from stored blocks: how many documents hold each."""
    held = stored.where("kind = 'pair'").groupBy("a", "b")
    return held.agg(F.sum("n").alias("documents"))


def _vector(rows: DataFrame, value: str, size: int) -> np.ndarray:
    """Values by id of A: at most as many rows as A has ids."""
    found = np.zeros(size, np.int64)
    table = rows.toArrow()
    found[table.column("a").to_numpy()] = table.column(value).to_numpy()
    return found


def token_pairs(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, documents): every pair of ids that are linked in some document, and in how many."""
    same = aligner(a_path, b_path).same
    stored = written_table(blocks(docs, a_path, b_path, id_col, text), "alignment")
    counts = _vector(stored.where("kind = 'same'").groupBy("a").agg(F.sum("n").alias("n")), "n", len(same))
    held = np.flatnonzero(counts)
    rows = zip(held.tolist(), same[held].tolist(), counts[held].tolist(), strict=True)
    regular = docs.sparkSession.createDataFrame(list(rows), "a int, b int, documents bigint")
    return regular.unionByName(pair_counts(stored))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document.

    Space and text are encoded by A (byte level), the text by B (which adds the space), both
    whole and without special tokens. Places where tokens of both end cut the bytes into groups;
    every token of A in a group is linked to every token of B there. ``n_best`` are links of a pair
    that no other pair of its id of A has more documents than, ``count_sum`` the sum over links of the
    documents that hold their pair. The digest is of the groups as ``a1,a2|b1;a3|b2``.

    Texts that are null or empty, or whose tokens' bytes are not space and text (a text with
    U+2581), have no tokens: zeros and an empty string. Repeated rows count and are returned as often
    as they occur, rows without id as well; other columns play no part; an empty table gives an
    empty table. A task holds a block of documents without their texts and what it remembers of
    chunks; a single text is held whole, with its distinct linked pairs.
    """
    size = len(aligner(a_path, b_path).same)
    stored = written_table(blocks(docs, a_path, b_path, id_col, text), "alignment")
    regular = stored.where("kind = 'same'").groupBy("a").agg(F.sum("n").alias("n"))
    same = _vector(regular, "n", size)
    totals = written_table(pair_counts(stored), "pairs")
    best = np.maximum(same, _vector(totals.groupBy("a").agg(F.max("documents").alias("n")), "n", size))
    held = stored.where("kind = 'pair'").select(F.col("block").alias("holder"), F.col("number").alias("pair"), "a", "b")
    answers = held.join(totals, ["a", "b"]).select("holder", "pair", "documents", "a")
    kind = stored.schema["id_"].dataType.simpleString()

    def weigh(found: pa.Table, known: pa.Table) -> pa.Table:
        n_best, count_sum = _weighed(found, known, same, best)
        columns = {name: found.column(name) for name in ("id_", "n_a", "n_b", "n_groups", "n_links")}
        columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table(columns | {"groups_sha256": found.column("groups_sha256")})

    schema = (
        f"id_ {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "n_best bigint, count_sum bigint, groups_sha256 string"
    )
    own = stored.where("kind = 'document'").drop("kind", "number", "a", "b", "n")
    found = own.groupBy("block").cogroup(answers.groupBy("holder")).applyInArrow(weigh, schema)
    return found.withColumnRenamed("id_", id_col)


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    ends = column.offsets.to_numpy().astype(np.int64)
    return ends - ends[0], column.flatten().to_numpy().astype(np.int64)


def _weighed(found: pa.Table, known: pa.Table, same: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of best pairs and sums of counts of each document of a block."""
    number = known.column("pair").to_numpy()
    width = int(number.max(initial=-1)) + 1
    total, is_best = np.zeros(width, np.int64), np.zeros(width, np.int64)
    total[number] = known.column("documents").to_numpy()
    is_best[number] = total[number] == best[known.column("a").to_numpy()]
    # by reference: -1 - a counts from the end
    total, is_best = np.concatenate([total, same[::-1]]), np.concatenate([is_best, (same == best)[::-1]])
    once_ends, once = _lists(found, "once")
    ends, refs = _lists(found, "refs")
    _, times = _lists(found, "times")
    sums = []
    for value in (is_best, total):
        run, more = np.append(0, np.cumsum(value[once])), np.append(0, np.cumsum(times * value[refs]))
        sums.append(run[once_ends[1:]] - run[once_ends[:-1]] + more[ends[1:]] - more[ends[:-1]])
    return sums[0], sums[1]
