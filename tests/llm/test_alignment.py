"""Alignment of two tokenizers, against whole texts encoded by the libraries."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidelog.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Results by id, and how many documents hold each pair."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    byte_of = alignment.byte_alphabet()

    def bytes_a(i):
        return bytes(byte_of[c] for c in a_model.id_to_token(i))

    def bytes_b(i):
        piece = b_model.IdToPiece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.IsByte(i) else piece.replace("▁", " ").encode()

    held, parts = collections.Counter(), []
    for i, text in rows:
        a, b, groups, ends = [], [], [], [0, 0]
        if text:
            a, b, whole = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text), (" " + text).encode()
            if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
                a, b = [], []
        left, right, of_a, of_b = iter(a), iter(b), [], []
        for _ in range(len(a) + len(b)):
            if ends[0] <= ends[1]:
                of_a.append(next(left))
                ends[0] += len(bytes_a(of_a[-1]))
            else:
                of_b.append(next(right))
                ends[1] += len(bytes_b(of_b[-1]))
            if ends[0] == ends[1]:
                groups.append((of_a, of_b))
                of_a, of_b = [], []
        links = [(x, y) for g, h in groups for x in g for y in h]
        held.update(set(links))
        parts.append((i, a, b, groups, links))
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    found = []
    for i, a, b, groups, links in parts:
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        sums = sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links)
        found.append((i, len(a), len(b), len(groups), len(links), *sums, digest))
    return sorted(found, key=repr), dict(held)


def strange_texts():
    rng = random.Random(3)
    parts = [*"ab \n\t\r.'s1é漢\xa0　▁\U0001f642 \x85\x1c\x00", "<|endoftext|>", "  ", "the", "ing", "<0x41>"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))) for k in range(1500)]
    rows += [(2000 + k, t) for k, t in enumerate((" ", "  ", "trail ", "\nlead", "▁", "a" * 3000, "==" * 50 + " \n" * 20))]
    return rows + [(5, rows[5][1]), (5, rows[5][1]), (None, "x y"), (None, None)]


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 3_000])
def test_alignment_of_strange_texts(make_docs, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(alignment, "PAIRS", 8)
    rows = strange_texts()
    want, held = brute(rows)
    docs = make_docs(rows)
    found = alignment.aligned(docs, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == want
    pairs = {(r.a, r.b): r.documents for r in alignment.token_pairs(docs, A, B).collect()}
    assert pairs == held


def test_alignment_of_long_and_repeated_texts(odd_docs, odd_rows, no_docs):
    want, _ = brute(odd_rows)
    assert sorted(map(tuple, alignment.aligned(odd_docs, A, B).collect()), key=repr) == want
    assert alignment.aligned(no_docs, A, B).count() == 0


def test_forgotten_chunks_are_aligned_anew(make_docs, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_BYTES", 0)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 200)
    rows = [(i, f"one two{i % 7} three  four\nfive, six {'seven ' * i}") for i in range(60)]
    assert sorted(map(tuple, alignment.aligned(make_docs(rows), A, B).collect()), key=repr) == brute(rows)[0]


def test_times_are_added_beyond_what_one_number_holds():
    key, times = np.array([5, 3, 5, 1 << 50]), np.array([1, 2, 1 << 40, 3])
    for top in (3, 4):
        found = alignment._added(key[:top], np.minimum(times[:top], 9 if top == 3 else 1 << 40))
        want = ([3, 5], [2, 10]) if top == 3 else ([3, 5, 1 << 50], [2, (1 << 40) + 1, 3])
        assert (found[0].tolist(), found[1].tolist()) == want


def test_identity_map_has_the_same_bytes():
    own = alignment.Aligner(A, B)
    held = [(a, b) for a, b in enumerate(own.same.tolist()) if b >= 0]
    assert len(held) > 5_000 and all(own.a.tokens[a] == own.b.tokens[b] for a, b in held)
