"""Benchmark decontamination and its search, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidelog.llm import decontam, wumanber

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width):
    patterns = {}
    for item, text in items:
        own = words(text)
        size = min(width, len(own))
        if item is not None and size:
            for k in range(len(own) - size + 1):
                patterns.setdefault(tuple(own[k : k + size]), set()).add(str(item))
    lengths = {len(p) for p in patterns}
    found = []
    for doc, text in docs:
        own, hit, met = words(text), set(), set()
        for size in lengths:
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in patterns:
                    hit |= set(range(k, k + size))
                    met |= patterns[tuple(own[k : k + size])]
        listed = sorted(met, key=str.encode)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        found.append((doc, len(own), len(hit), len(met), digest, bool(hit)))
    return sorted(found, key=repr)


def tables(spark, make_docs, seed):
    rng = random.Random(seed)
    letters = ["a", "B", "c9", "É", "é", "漢字", "x", "the"]

    def text(n):
        return "".join(rng.choice(letters) + rng.choice([" ", ", ", "\n", "-", "_\x00"]) for _ in range(n))

    items = [(i, text(rng.randint(1, 14))) for i in range(30)]
    items += [(40, None), (41, ""), (42, " .,! "), (None, text(12)), (3, text(9)), (43, items[5][1]), (44, "lone")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(120)]
    docs += [(200 + i, text(20) + items[i][1].upper() + text(20)) for i in range(30)]
    docs += [(7, docs[7][1]), (7, docs[7][1]), (300, None), (301, ""), (302, "lone"), (None, items[2][1]), (303, text(9000))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' words", "1 length")
    return docs, items, make_docs(docs), benchmark


@pytest.mark.parametrize("width, part_bytes", [(10, decontam.PART_BYTES), (3, decontam.PART_BYTES), (4, 1500)])
def test_hits_are_those_of_all_windows(spark, make_docs, width, part_bytes):
    docs, items, table, benchmark = tables(spark, make_docs, width)
    found = decontam.contaminated(table, benchmark, width=width, part_bytes=part_bytes)
    counts = decontam.hit_counts(found)
    assert sorted(map(tuple, counts.collect()), key=repr) == brute(docs, items, width)
    spans = {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in found.collect()}
    assert all(a < b and (k == 0 or s[k - 1][1] < a) for s in spans.values() for k, (a, b) in enumerate(s))


def test_empty_tables(spark, make_docs, no_docs):
    docs, _, table, benchmark = tables(spark, make_docs, 1)
    assert decontam.contaminated(no_docs, benchmark).count() == 0
    clean = decontam.hit_counts(decontam.contaminated(table, benchmark.limit(0)))
    assert sorted(map(tuple, clean.collect()), key=repr) == brute(docs, [], 10)


@pytest.mark.parametrize("length", [1, 2, 3, 10])
def test_search_finds_every_occurrence(monkeypatch, length):
    monkeypatch.setattr(wumanber, "LANES", 7)
    monkeypatch.setattr(wumanber, "PAIRS", 5)
    rng = np.random.default_rng(length)
    patterns = np.unique(rng.integers(1, 4, (40, length)), axis=0)
    run = rng.integers(0, 4, 4000)
    run[100 : 100 + length] = patterns[0]
    at, number = wumanber.Search(patterns).occurrences(run)
    rows = {tuple(p): i for i, p in enumerate(patterns.tolist())}
    want = [(k, rows[tuple(w)]) for k in range(len(run) - length + 1) if tuple(w := run[k : k + length].tolist()) in rows]
    assert sorted(zip(at.tolist(), number.tolist(), strict=True)) == want


def test_blocks_of_no_pattern_are_skipped():
    search = wumanber.Search(np.arange(1, 11)[None, :])
    looked = []
    shift = search.shift

    class Counted:
        def __getitem__(self, at):
            looked.append(len(at))
            return shift[at]

    search.shift = Counted()
    assert len(search.occurrences(np.zeros(90_000, np.int64))[0]) == 0
    assert sum(looked) <= 10_000 + wumanber.LANES


def test_other_buckets_of_equal_hash_are_told_apart(monkeypatch):
    patterns = np.array([[1, 2, 3], [4, 5, 6], [7, 8, 9]])
    monkeypatch.setattr(wumanber.Search, "_key", lambda self, words: np.zeros(len(words[0]), np.uint64))
    at, number = wumanber.Search(patterns).occurrences(np.array([0, 4, 5, 6, 1, 2, 3, 4, 5, 9]))
    assert sorted(zip(at.tolist(), number.tolist(), strict=True)) == [(1, 1), (4, 0)]
