"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each document. How often each pattern of
votes occurs is counted over all documents; expectation-maximisation on these counts
estimates how accurate each labeller is on good and on bad documents, and with that how
likely each pattern is good. These posteriors are the labels of a linear scorer over hashed byte
trigrams and votes, which then scores every document.

Patterns are at most 2 to the power of the number of labellers, whatever the corpus, as each
labeller casts one kind of vote.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.frames import free_name, written_table
from tidelog.llm.pieces import forget

GOOD, BAD, NONE = 1, -1, 0
#: Labellers: the vote, and the least and greatest share at which it is cast.
LABELLERS = {
    "shouting": (BAD, 0.5, 1e9),  # upper case among letters
    "symbols": (BAD, 0.3, 1e9),  # of #*$%&|<> for each word
    "emphasis": (BAD, 0.3, 1e9),  # exclamation marks for each word
    "echo": (BAD, 0.3, 1e9),  # words in repeated windows of eight words
    "stutter": (BAD, 0.2, 1e9),  # words like the word before
    "lines": (BAD, 0.3, 1e9),  # repeated lines
    "marks": (BAD, 0.2, 1e9),  # words without letter or digit
    "sameness": (BAD, 0.8, 1e9),  # words that occurred before
    "sentences": (GOOD, 0.02, 0.4),  # words that end in a stop or comma
    "short_words": (GOOD, 0.1, 0.9),  # words of at most three bytes, all letters
}
#: Bytes of texts that are looked at at a time.
SLICE_BYTES = 2 << 20
#: Texts of fewer words get no votes.
LEAST_WORDS = 10
#: The pattern of such a text.
NOT_ASKED = -1
#: Rounds of expectation-maximisation, and what is added to each count of votes.
ROUNDS, SMOOTH = 100, 1.0

#: The scorer is fitted on at most so many likely good and so many likely bad texts.
FIT_TEXTS = 1_500
BITS, FIT_ROUNDS, FIT_STEP, FIT_DECAY = 16, 80, 0.5, 1e-5
GRAM_SCALE = 30.0
#: Documents that are less likely good than this are rejected.
THRESHOLD = 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
UPPER, LOWER, LETTER = (np.zeros(256, bool) for _ in range(3))
UPPER[65:91] = LOWER[97:123] = True
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


@dataclass(frozen=True)
class Scorer:
    """Weights of hashed trigrams, of votes [labeller, vote + 1], and a constant."""

    grams: np.ndarray
    votes: np.ndarray
    constant: float


def votes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Votes [text, labeller], and the number of words of each text."""
    found = T.words(texts)
    n = len(texts)
    n_words = np.diff(found.first)
    some = np.maximum(n_words, 1)
    codes, _ = T.coded(found.values())

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.bincount(found.text, weights=mask, minlength=n) / some

    upper, lower = (T.per_text(found.ends, kind[found.data]) for kind in (UPPER, LOWER))
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (found.text[1:] == found.text[:-1])
    distinct = np.sort(found.text * (int(codes.max(initial=0)) + 1) + codes)
    head = distinct[np.append(True, distinct[1:] != distinct[:-1])[: len(distinct)]]
    own_words = np.bincount(head // (int(codes.max(initial=0)) + 1), minlength=n)
    text, line, _ = T.lines(texts)
    n_lines = np.bincount(text, minlength=n)
    own_lines = np.bincount(np.unique(line * (n + 1) + text) % (n + 1), minlength=n)
    if len(codes):
        kinds = np.where(T.SPACE[found.data], 0, np.where(LETTER[found.data], 1, 2)).astype(np.uint8)
        kinds = np.bitwise_or.reduceat(kinds, found.start)
        last = found.data[found.stop - 1]
    else:
        kinds, last = np.zeros(0, np.uint8), np.zeros(0, np.uint8)
    shares = {
        "shouting": upper / np.maximum(upper + lower, 1),
        "symbols": T.per_text(found.ends, SYMBOL[found.data]) / some,
        "emphasis": T.per_text(found.ends, found.data == 33) / some,
        "echo": per_word(T.repeated_words(found, codes)),
        "stutter": per_word(again),
        "lines": (n_lines - own_lines) / np.maximum(n_lines, 1),
        "marks": per_word(kinds == 2),
        "sameness": 1 - own_words / some,
        "sentences": per_word((last == 44) | (last == 46)),
        "short_words": per_word((found.stop - found.start <= 3) & (kinds == 1)),
    }
    out = np.zeros((n, len(LABELLERS)), np.int8)
    for place, (name, (vote, low, high)) in enumerate(LABELLERS.items()):
        out[:, place] = np.where((shares[name] >= low) & (shares[name] <= high), vote, NONE)
    out[n_words < LEAST_WORDS] = NONE
    return out, n_words


def _pattern(texts: pa.Array) -> np.ndarray:
    cast, size = votes(texts)
    return np.where(size < LEAST_WORDS, NOT_ASKED, (cast != NONE) @ 2 ** np.arange(cast.shape[1]))


def label_model(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(how likely each pattern is good, vote rates [class, labeller], share of good).

    A labeller votes on bad and on good documents at a rate of its own each, independently
    of the others. Starts from the majority, no vote counting as good; texts that were not
    asked are as likely good as any.
    """
    asked = patterns != NOT_ASKED
    voted = (patterns[asked, None] >> np.arange(len(LABELLERS)) & 1).astype(float)
    number = counts[asked]
    sign = np.array([vote for vote, _, _ in LABELLERS.values()])
    good = 1 / (1 + np.exp(-2.0 * (voted @ sign + 0.5)))
    rates, share = np.full((2, len(LABELLERS)), 0.5), 0.5
    for _ in range(ROUNDS):
        log = []
        share = (SMOOTH + number @ good) / (2 * SMOOTH + number.sum())
        for kind, (weight, prior) in enumerate(((number * (1 - good), 1 - share), (number * good, share))):
            rate = rates[kind] = (SMOOTH + weight @ voted) / (2 * SMOOTH + weight.sum())
            log.append(np.log(prior) + voted @ np.log(rate) + (1 - voted) @ np.log(1 - rate))
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
    out = np.full(len(patterns), share)
    out[asked] = good
    return out, rates, float(share)


def _grams(data: np.ndarray) -> np.ndarray:
    """The hashed trigram that starts at each byte but the last two."""
    wide = data.astype(np.uint32)
    value = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    return ((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


def _mean_weight(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The mean weight of each text's trigrams, 0 for texts of fewer than three bytes."""
    ends, data = T.buffers(texts)
    out = np.zeros(len(texts))
    if len(data) < 3:
        return out
    run = np.append(0.0, np.cumsum(weights[_grams(data)]))
    stop = np.maximum(ends[1:] - 2, ends[:-1])
    size = stop - ends[:-1]
    some = np.flatnonzero(size)
    out[some] = (run[stop[some]] - run[ends[:-1][some]]) / size[some]
    return out


def fit_scorer(texts: pa.Array, good: np.ndarray, weight: np.ndarray) -> Scorer:
    """Logistic regression on soft labels ``good`` with the rows' weights."""
    cast, _ = votes(texts)
    ends, data = T.buffers(texts)
    rows, columns, values = [], [], []
    for row in range(len(texts)):
        part = data[ends[row] : ends[row + 1]]
        if len(part) > 2:
            found, times = np.unique(_grams(part), return_counts=True)
            rows.append(np.full(len(found), row))
            columns.append(found)
            values.append(GRAM_SCALE * times / (len(part) - 2))
    if not rows:
        return Scorer(np.zeros(1 << BITS), np.zeros((len(LABELLERS), 3)), 0.0)
    rows, columns, values = map(np.concatenate, (rows, columns, values))
    grams, by_vote, constant = np.zeros(1 << BITS), np.zeros((len(LABELLERS), 3)), 0.0
    seen = [np.full_like(grams, 1e-6), np.full_like(by_vote, 1e-6), 1e-6]
    weight = weight / weight.sum()
    place = np.arange(len(LABELLERS))
    for _ in range(FIT_ROUNDS):
        score = constant + by_vote[place, cast + 1].sum(axis=1)
        score += np.bincount(rows, weights=values * grams[columns], minlength=len(texts))
        miss = weight * (good - 1 / (1 + np.exp(-np.clip(score, -60, 60))))
        slope = np.bincount(columns, weights=values * miss[rows], minlength=1 << BITS) - FIT_DECAY * grams
        vote_slope = np.stack([((cast == v) * miss[:, None]).sum(axis=0) for v in (BAD, NONE, GOOD)], axis=1)
        vote_slope -= FIT_DECAY * by_vote
        seen = [seen[0] + slope**2, seen[1] + vote_slope**2, seen[2] + miss.sum() ** 2]
        grams += FIT_STEP * slope / np.sqrt(seen[0])
        by_vote += FIT_STEP * vote_slope / np.sqrt(seen[1])
        constant += FIT_STEP * miss.sum() / np.sqrt(seen[2])
    return Scorer(grams * GRAM_SCALE, by_vote, float(constant))


def patterns(text: Column) -> Column:
    """The pattern of votes on ``text`` as a number."""

    @F.arrow_udf("int")
    def pattern(values: pa.Array) -> pa.Array:
        forget()
        parts = [_pattern(part) for _, part in T.slices(T.plain(values), SLICE_BYTES)]
        return pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int32())

    return pattern(text)


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Scorer:
    """The scorer for ``docs``: votes of all rows, and a fit on at most 2 * FIT_TEXTS of them."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    cast = written_table(rows.select("id", patterns(F.col("text")).alias("pattern")), "votes")
    found = cast.groupBy("pattern").count().orderBy("pattern").collect()  # bounded, see above
    numbers = np.array([row["pattern"] for row in found], np.int64)
    counts = np.array([row["count"] for row in found], float)
    if not len(numbers):
        return Scorer(np.zeros(1 << BITS), np.zeros((len(LABELLERS), 3)), 0.0)
    good, _, _ = label_model(numbers, counts)
    likely = F.col("pattern").isin(numbers[good >= 0.5].tolist())
    chosen = []
    for side, number in ((likely, counts[good >= 0.5].sum()), (~likely, counts[good < 0.5].sum())):
        # of many ids only those that hash low are sorted, four times as many as are taken
        top = (1 << 62) // max(1, int(number) // (4 * FIT_TEXTS))
        low = F.shiftrightunsigned(F.xxhash64("id"), 2) <= top
        some = cast.where(side & low).orderBy(F.xxhash64("id"), "id").limit(FIT_TEXTS)
        chosen.append(some.select("id").distinct())
    # at most 2 * FIT_TEXTS ids, so they may be sent to every task
    some = rows.join(F.broadcast(chosen[0].union(chosen[1]).distinct()), "id").dropDuplicates(["id"])
    texts = T.plain(pa.array([row["text"] for row in some.orderBy("id").collect()], pa.string()))
    if not len(texts):
        return Scorer(np.zeros(1 << BITS), np.zeros((len(LABELLERS), 3)), 0.0)
    own = dict(zip(numbers.tolist(), good.tolist(), strict=True))
    label = np.array([own.get(p, 0.5) for p in _pattern(texts).tolist()])
    sides = label >= 0.5
    sizes = [counts[good < 0.5].sum(), counts[good >= 0.5].sum()]
    weight = np.where(sides, sizes[1] / max(sides.sum(), 1), sizes[0] / max((~sides).sum(), 1))
    return fit_scorer(texts, label, weight)


def scored(text: Column, scorer: Scorer) -> Column:
    """How likely ``text`` is good; 0 without words."""

    @F.arrow_udf("double")
    def score(values: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        place = np.arange(len(LABELLERS))
        forget()
        for _, part in T.slices(T.plain(values), SLICE_BYTES):
            cast, size = votes(part)
            total = scorer.constant + scorer.votes[place, cast + 1].sum(axis=1) + _mean_weight(part, scorer.grams)
            out.append(np.where(size > 0, 1 / (1 + np.exp(-np.clip(total, -60, 60))), 0.0))
        return pa.array(np.concatenate(out), pa.float64())

    return score(text)


def quality_scores(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, kept), one row per row of ``docs``.

    Texts without words (null, empty) score 0. Whole texts count; repeated rows give repeated
    rows; other columns play no part; an empty table gives an empty table.
    """
    found = docs.select(id_col, scored(F.col(text), scorer).alias("score"))
    return found.withColumn("kept", F.col("score") >= THRESHOLD)


def good_ones(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    score = free_name(docs, "score")
    return docs.withColumn(score, scored(F.col(text), scorer)).where(F.col(score) >= THRESHOLD).drop(score)
