import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidelog.llm import texts as T

ALPHABET = ["a", "b", "é", "\n", " ", "\t", "ß", "x y", "\r", "", "漢"]


def some_texts(n=400):
    rng = random.Random(1)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["", "   ", "\n\n"]


def test_words_and_repeats_match_plain_python():
    texts = some_texts()
    array = T.plain(pa.array(["dropped", *texts])).slice(1)
    found = T.words(array)
    want = [re.findall(r"[^\x20\x09-\x0d]+", t) for t in texts]
    assert [v.decode() for v in found.values().to_pylist()] == [w for ws in want for w in ws]
    codes, _ = T.coded(found.values())
    marked = T.repeated_words(found, codes)
    for i, ws in enumerate(want):
        windows = Counter(tuple(ws[k : k + 8]) for k in range(len(ws) - 7))
        mine = [False] * len(ws)
        for k in range(len(ws) - 7):
            if windows[tuple(ws[k : k + 8])] > 1:
                mine[k : k + 8] = [True] * 8
        assert list(marked[found.first[i] : found.first[i + 1]]) == mine


def test_colliding_window_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(T, "mixed", lambda numbers: np.zeros(len(numbers), np.uint64))
    texts = T.plain(pa.array(["a b c d e f g h i", "1 2 3 4 5 6 7 8 x 1 2 3 4 5 6 7 8"]))
    found = T.words(texts)
    codes, _ = T.coded(found.values())
    assert T.repeated_words(found, codes).tolist() == [False] * 9 + [True] * 8 + [False] + [True] * 8


def test_lines_match_plain_python():
    texts = some_texts()
    text, line, _ = T.lines(T.plain(pa.array(texts)))
    for i, t in enumerate(texts):
        want = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        mine = line[text == i]
        assert len(mine) == len(want) and len(set(mine)) == len(set(want))


def test_slices_cover_all_texts():
    array = T.plain(pa.array(some_texts()))
    parts = list(T.slices(array, 100))
    assert len(parts) > 3 and [t for _, part in parts for t in part.to_pylist()] == array.to_pylist()
