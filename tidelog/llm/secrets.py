"""Secret scan: fixed rules, and a linear-chain conditional random field.

The rules find keyed assignments, access keys and long hexadecimal runs. The field tags
each word of a line as begin, inside or outside of a secret by its shape, the words around
it and features of the whole text; Viterbi decodes the best tags, and tagged words that no
rule covers become further spans. The field is fitted on what the rules find in a bounded
sample of texts, so it carries their shapes and contexts over to secrets in other formats.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.frames import free_name
from tidelog.llm.pieces import held

#: The rules, in the order in which equal starts are listed, the group whose
#: length counts and the least length.
RULES = {
    "assign": (
        re.compile(
            r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII,
        ),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
LEARNED = "crf"
KINDS = [*RULES, LEARNED]
#: What a text must hold for any rule to match (a wider test, run over whole batches).
HINT = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""

#: Bytes of texts that are scanned at a time.
SLICE_BYTES = 1 << 20
#: The fit takes at most so many distinct texts that the hint matches and so many others. Of
#: longer texts than so many characters it takes that much, around the first hint if there is one.
FIT_TEXTS, FIT_CHARS = 200, 4_000
FIT_ROUNDS, FIT_STEP, FIT_DECAY, FIT_LINE = 30, 0.7, 1.0, 64

SCHEMA = "n_assign bigint, n_access bigint, n_hex bigint, n_learned bigint, base_sha256 string, spans string"

BEGIN, INSIDE, OUTSIDE = range(3)
WORD_BITS = 14
#: Feature slots: name and size of each.
SLOTS = {
    "shape": 2048,
    "rough": 64,
    "shape_before": 2048,
    "shape_after": 2048,
    "word": 1 << WORD_BITS,
    "word_before": 1 << WORD_BITS,
    "word_before_that": 1 << WORD_BITS,
    "word_after": 1 << WORD_BITS,
    "file": 64,
}
BASES = dict(zip(SLOTS, np.cumsum([0, *SLOTS.values()])[:-1].tolist(), strict=True))
WIDTH = sum(SLOTS.values())

#: One bit for each class of bytes.
CLASS = np.full(256, 64, np.uint8)
CLASS[T.SPACE] = 0
CLASS[128:] = 128
for _chars, _bit in (("abcdef", 1), ("ghijklmnopqrstuvwxyz", 2), ("ABCDEF", 4), ("GHIJKLMNOPQRSTUVWXYZ", 8), ("0123456789", 16), ("+/_=-", 32)):
    CLASS[[ord(c) for c in _chars]] = _bit
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
LOWER[T.SPACE] = 0
LENGTHS = np.array([2, 4, 8, 12, 16, 24, 40])
FACTOR = 0x100000001B3


@dataclass(frozen=True)
class Field:
    """Weights of the features by label, and of neighbouring labels."""

    weights: np.ndarray
    moves: np.ndarray


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of what counts) by start, then kind as listed."""
    found = []
    for kind, (pattern, group, least) in RULES.items():
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), match.end(), kind, match.start(group)))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _hinted(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts, HINT).to_numpy(zero_copy_only=False)


def _powers(size: int, factor: int) -> np.ndarray:
    run = np.full(size, factor, np.uint64)
    run[:1] = 1
    return np.multiply.accumulate(run)


def _word_numbers(found: T.Words) -> np.ndarray:
    """A hashed number for each word, the same for upper and lower case."""
    if not len(found.start):
        return np.zeros(0, np.int64)
    size = 1 << max(20, int(len(found.data)).bit_length())
    inverse = pow(FACTOR, -1, 1 << 64)
    up, down = held(("secrets", size), lambda: (_powers(size, FACTOR), _powers(size, inverse)))
    total = np.add.reduceat(LOWER[found.data] * up[: len(found.data)], found.start)
    return (T.mixed(total * down[found.start]) >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def features(found: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers [word, slot], and the number of each word's line."""
    n = len(found.start)
    if not n:
        return np.zeros((0, len(SLOTS)), np.int64), np.zeros(0, np.int64)
    classes = CLASS[found.data]
    size = found.stop - found.start
    shape = np.bitwise_or.reduceat(classes, found.start).astype(np.int64)
    shape += 256 * np.searchsorted(LENGTHS, size, "right")
    letter, digit, other = (shape & 15) > 0, (shape & 16) > 0, (shape & 224) > 0
    rough = 8 * (shape >> 8) + 4 * letter + 2 * digit + other
    word = _word_numbers(found)
    feeds = np.append(0, np.cumsum(found.data == 10))
    line = feeds[found.start] + found.text
    total = np.maximum(np.diff(found.ends), 1)
    digits = 100 * T.per_text(found.ends, classes == 16) // total
    file = 8 * np.minimum(digits, 7) + np.minimum(np.log2(np.maximum(np.diff(found.first), 1)) / 2, 7).astype(int)

    def near(values: np.ndarray, step: int, size: int) -> np.ndarray:
        """The value ``step`` words on in the same text, else the last number of the slot."""
        out = np.full(n, size - 1)
        here, there = (slice(None, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(None, step))
        if n > abs(step):
            same = found.text[here] == found.text[there]
            out[here] = np.where(same, values[there], size - 1)
        return out

    columns = [
        shape,
        rough,
        near(shape, -1, SLOTS["shape_before"]),
        near(shape, 1, SLOTS["shape_after"]),
        word,
        near(word, -1, SLOTS["word"]),
        near(word, -2, SLOTS["word"]),
        near(word, 1, SLOTS["word"]),
        file[found.text],
    ]
    return np.stack([c + b for c, b in zip(columns, BASES.values(), strict=True)], axis=1), line


def _scores(field: Field, numbers: np.ndarray) -> np.ndarray:
    total = field.weights[numbers[:, 0]]
    for slot in range(1, numbers.shape[1]):
        total += field.weights[numbers[:, slot]]
    return total


def viterbi(scores: np.ndarray, moves: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The best labels of each line.

    A word is surely outside if that beats each other label by more than any change of its
    two moves can win back. Such words part the lines into short runs, which are decoded
    side by side, step by step; the result is that of decoding whole lines.
    """
    n = len(scores)
    labels = np.full(n, OUTSIDE, np.int8)
    gain = np.array(
        [
            max(0, *(moves[:, y] - moves[:, OUTSIDE])) + max(0, *(moves[y] - moves[OUTSIDE]))
            for y in (BEGIN, INSIDE)
        ]
    )
    open_ = ((scores[:, OUTSIDE, None] - scores[:, :OUTSIDE]) <= gain).any(axis=1)
    if not open_.any():
        return labels
    joins = open_[1:] & open_[:-1] & (line[1:] == line[:-1])
    begins = np.flatnonzero(open_ & np.append(True, ~joins))
    stops = np.flatnonzero(open_ & np.append(~joins, True)) + 1
    order = np.argsort(begins - stops, kind="stable")  # longest first
    begins, stops = begins[order], stops[order]
    size = stops - begins
    back = np.zeros((n, 3), np.int8)
    before = (begins > 0) & (line[np.maximum(begins - 1, 0)] == line[begins])
    after = (stops < n) & (line[np.minimum(stops, n - 1)] == line[begins])
    best = scores[begins] + np.where(before[:, None], moves[OUTSIDE], 0)
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
    for step in range(1, size[0]):
        k = active[step]
        at = begins[:k] + step
        ways = best[:k, :, None] + moves
        back[at] = ways.argmax(axis=1)
        best[:k] = ways.max(axis=1) + scores[at]
    best += np.where(after[:, None], moves[:, OUTSIDE], 0)
    last = best.argmax(axis=1)
    for step in range(size[0] - 1, -1, -1):
        k = active[step]
        at = begins[:k] + step
        labels[at] = last[:k]
        if step:
            last[:k] = back[at, last[:k]]
    return labels


def _sum_exp(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def fit_field(texts: list[str]) -> Field:
    """Fits the field to what the rules find in ``texts``; if that is nothing, it tags nothing."""
    weights, moves = np.zeros((WIDTH, 3)), np.zeros((3, 3))
    array = T.plain(pa.array(texts, pa.string()))
    found = T.words(array)
    numbers, line = features(found)
    labels = np.full(len(numbers), OUTSIDE)
    for row, text in enumerate(texts):
        for _, end, _, start in base_spans(text):
            at = found.ends[row] + len(text[:start].encode())
            to = found.ends[row] + len(text[:end].encode())
            first, last = np.searchsorted(found.stop, at, "right"), np.searchsorted(found.start, to)
            labels[first:last] = INSIDE
            labels[first : first + 1] = BEGIN
    if (labels == OUTSIDE).all():
        weights[:, OUTSIDE] = 1.0
        return Field(weights.astype(np.float32), moves.astype(np.float32))
    head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    place = np.arange(len(line)) - np.repeat(head, np.diff(np.append(head, len(line))))
    begins = np.flatnonzero(place % FIT_LINE == 0)
    size = np.diff(np.append(begins, len(line)))
    order = np.argsort(-size, kind="stable")
    begins, size = begins[order], size[order]
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
    seen, seen_moves = np.ones_like(weights), np.ones_like(moves)
    for _ in range(FIT_ROUNDS):
        scores = _scores(Field(weights, moves), numbers)
        ahead = np.zeros_like(scores)
        ahead[begins] = scores[begins]
        for step in range(1, size[0]):
            at = begins[: active[step]] + step
            ahead[at] = _sum_exp(ahead[at - 1][:, :, None] + moves, 1) + scores[at]
        behind = np.zeros_like(scores)
        ends = begins + size - 1
        whole = np.zeros(len(scores))
        whole[begins] = _sum_exp(ahead[ends], 1)
        slope_moves = np.zeros_like(moves)
        for step in range(size[0] - 1, 0, -1):
            first = begins[: active[step]]
            at = first + step
            rest = (scores[at] + behind[at])[:, None, :] + moves
            behind[at - 1] = _sum_exp(rest, 2)
            slope_moves -= np.exp(ahead[at - 1][:, :, None] + rest - whole[first][:, None, None]).sum(axis=0)
            slope_moves += np.bincount(3 * labels[at - 1] + labels[at], minlength=9).reshape(3, 3)
        norm = np.repeat(whole[np.sort(begins)], np.diff(np.append(np.sort(begins), len(scores))))
        slope = -np.exp(ahead + behind - norm[:, None])
        slope[np.arange(len(labels)), labels] += 1
        total = np.zeros_like(weights)
        for label in range(3):
            for slot in range(numbers.shape[1]):
                total[:, label] += np.bincount(numbers[:, slot], weights=slope[:, label], minlength=WIDTH)
        total -= FIT_DECAY * weights
        seen += total**2
        seen_moves += slope_moves**2
        weights += FIT_STEP * total / np.sqrt(seen)
        moves += FIT_STEP * slope_moves / np.sqrt(seen_moves)
    return Field(weights.astype(np.float32), moves.astype(np.float32))


def fit(docs: DataFrame, text: str = "text") -> Field:
    """The field fitted on a bounded sample of ``docs``: FIT_TEXTS hinted and as many other texts.

    Copies of a text count once, so that they neither crowd the sample nor thin it out. Null and
    empty texts are not looked at; a table without others gives a field that tags nothing.
    """
    hint = HINT.replace("(?i:", "(?:(?i)")
    rows = docs.select(F.col(text).alias("t")).where(F.length("t") > 0)
    rows = rows.select("t", F.xxhash64("t").alias("hash"), F.col("t").rlike(hint).alias("hinted"))
    distinct = F.approx_count_distinct("hash")
    counts = {row["hinted"]: row["n"] for row in rows.groupBy("hinted").agg(distinct.alias("n")).collect()}
    room = F.length("t") - FIT_CHARS
    around = F.regexp_instr("t", F.lit(hint)) - FIT_CHARS // 2
    first = F.when(F.col("hinted"), around).otherwise(F.pmod("hash", F.greatest(room, F.lit(1))) + 1)
    first = F.greatest(F.lit(1), F.least(first, room + 1)).cast("int")
    part = F.when(room > 0, F.substring("t", first, F.lit(FIT_CHARS))).otherwise(F.col("t"))
    chosen = []
    for side, number in sorted(counts.items(), reverse=True):
        # of many texts only those that hash low are sorted, some four times as many as are taken
        top = (1 << 62) // max(1, number // (4 * FIT_TEXTS))
        low = F.shiftrightunsigned("hash", 2) <= top
        some = rows.where((F.col("hinted") == side) & low).select("hash", part.alias("part")).distinct()
        chosen += [row["part"] for row in some.orderBy("hash", "part").limit(FIT_TEXTS).collect()]
    return fit_field(chosen)


def _learned(found: T.Words, field: Field) -> dict[int, list[tuple[int, int]]]:
    """Byte spans of tagged words by text."""
    numbers, line = features(found)
    labels = viterbi(_scores(field, numbers), field.moves, line)
    spans: dict[int, list[tuple[int, int]]] = {}
    for at in np.flatnonzero(labels != OUTSIDE).tolist():
        text = int(found.text[at])
        base = int(found.ends[text])
        mine = spans.setdefault(text, [])
        start, stop = int(found.start[at]) - base, int(found.stop[at]) - base
        follows = labels[at] == INSIDE and at and labels[at - 1] != OUTSIDE and line[at - 1] == line[at]
        if follows and mine:
            mine[-1] = (mine[-1][0], stop)
        else:
            mine.append((start, stop))
    return spans


def all_spans(texts: pa.Array, field: Field) -> dict[int, list[tuple[int, int, str]]]:
    """Spans (start, end, kind) in code points by number of text, for texts that have any."""
    learned = _learned(T.words(texts), field)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for row in sorted({*np.flatnonzero(_hinted(texts)).tolist(), *learned}):
        text = texts[row].as_py()
        spans = [(a, b, kind) for a, b, kind, _ in base_spans(text)]
        covered = sorted((a, b) for a, b, _ in spans)
        data = text.encode() if row in learned else b""
        for start, stop in learned.get(row, ()):
            a = len(data[:start].decode())
            b = a + len(data[start:stop].decode())
            if not any(a < d and c < b for c, d in covered):
                spans.append((a, b, LEARNED))
        if spans:
            found[row] = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _digest(texts: pa.Array, field: Field) -> list[tuple]:
    found = all_spans(texts, field)
    nothing = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    rows = [nothing] * len(texts)
    for row, spans in found.items():
        base = _listed([s for s in spans if s[2] != LEARNED])
        counts = [sum(s[2] == kind for s in spans) for kind in KINDS]
        rows[row] = (*counts, hashlib.sha256(base.encode()).hexdigest(), _listed(spans))
    return rows


def span_digests(text: Column, field: Field) -> Column:
    """A struct of the number of spans by kind, a digest of the rules' spans, and all spans."""
    names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]
    kinds = pa.struct([(n, pa.string() if n in ("base_sha256", "spans") else pa.int64()) for n in names])

    @F.arrow_udf(SCHEMA)
    def digest(values: pa.Array) -> pa.Array:
        rows = [row for _, part in T.slices(T.plain(values), SLICE_BYTES) for row in _digest(part, field)]
        return pa.array([dict(zip(names, row, strict=True)) for row in rows], kinds)

    return digest(text)


def hidden(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(text: Column, field: Field, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark`` (null: null)."""

    @F.arrow_udf("string")
    def redact(values: pa.Array) -> pa.Array:
        out = []
        nulls = values.is_null().to_numpy(zero_copy_only=False)
        for first, part in T.slices(T.plain(values), SLICE_BYTES):
            rows = part.to_pylist()
            for row, spans in all_spans(part, field).items():
                rows[row] = hidden(rows[row], spans, mark)
            out += [None if nulls[first + i] else row for i, row in enumerate(rows)]
        return pa.array(out, pa.string())

    return redact(text)


def secret_spans(docs: DataFrame, field: Field, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, counts and spans.

    A null or empty text has no spans. Texts are scanned whole. Repeated rows give repeated
    rows; other columns play no part; an empty table gives an empty table.
    """
    found = docs.select(id_col, span_digests(F.col(text), field).alias("_found"))
    return found.select(id_col, "_found.*")


def redact_column(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced; all rows and other columns stay."""
    column = free_name(docs, "redacted")
    clean = docs.withColumn(column, redacted(F.col(text), field))
    return clean.select(*[F.col(column).alias(c) if c == text else F.col(c) for c in docs.columns])
