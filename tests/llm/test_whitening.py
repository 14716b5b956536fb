"""Embedding whitening and spectrum slicing, against numpy's eigenvectors and exact fractions."""

import numpy as np
import pytest

from tidelog.llm import spectrum, whitening


def symmetric(values, seed):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    found = (turn * values) @ turn.T
    return (found + found.T) / 2


@pytest.mark.parametrize("seed", range(40))
def test_inertia_counts(seed):
    rng = np.random.default_rng(seed)
    matrix = rng.standard_normal((1 + seed % 9, 1 + seed % 9))
    matrix = np.round(matrix + matrix.T) if seed % 2 else matrix + matrix.T
    shift = rng.standard_normal() + 1e-3
    assert spectrum.above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(9, 1, 30),
        np.ones(20),
        np.r_[np.full(7, 5.0), np.full(7, 2.0)],
        np.r_[1 + 1e-13 * np.arange(10), np.full(10, 0.5)],
        1 + 1e-9 * np.arange(20),
        10.0 ** -np.arange(12),
        1e12 * (1 + 1e-11 * np.arange(12)),
        np.r_[3.0, np.zeros(6)],
        np.array([4.0]),
        np.zeros(4),
    ],
)
def test_leading_eigenpairs(values):
    matrix = symmetric(values, len(values))
    found, vectors = spectrum.leading(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    top = max(want[0], 1e-300)
    assert len(found) == (want > 1e-12 * top).sum() or len(found) == 0 == want.max()
    assert np.abs(found - want[: len(found)]).max(initial=0) < 1e-13 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max(initial=0) < 1e-13 * top


def test_a_wrong_number_is_an_error(monkeypatch):
    monkeypatch.setattr(spectrum.Slices, "certified", lambda self, value, margin, number: False)
    with pytest.raises(ArithmeticError):
        spectrum.leading(symmetric(np.arange(1.0, 6.0), 1), 3)


def brute(vectors, components):
    """For vectors of one length: deviations, whitened columns (up to sign) and explained shares."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    covariance = centred.T @ centred / n
    values, own = np.linalg.eigh(covariance)
    values, own = values[::-1][:components], own[:, ::-1][:, :components]
    return deviations, centred @ own / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(covariance)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    spread = np.linspace(3, 0.2, 12)
    found = [(i, (rng.standard_normal(12) * spread + 5).astype(np.float32).tolist()) for i in range(300)]
    return found + [(3, found[3][1]), (3, found[3][1]), (4, found[9][1]), (None, found[8][1])]


def test_whitened_rows(spark, rows):
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, []), (902, [None] * 12), (903, [nan] + [1.0] * 11), (904, [1.0] * 11 + [-inf])]
    vectors = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").selectExpr("*", "1 n", "2 id_", "3 vector_")
    found = whitening.whitened(vectors).collect()
    deviations, columns, explained = brute([v for _, v in rows], 32)
    assert len(found) == len(rows) * 12 and {r.n for r in found} == {len(rows)}
    assert sorted((repr(r.vec_id), r.deviation) for r in found if r.component == 1) == sorted(
        (repr(i), d) for (i, _), d in zip(rows, deviations, strict=True)
    )
    for k in range(12):
        mine = [r for r in found if r.component == k + 1]
        got = sorted((repr(r.vec_id), r.deviation, r.whitened) for r in mine)
        sign = 1
        for sign in (1, -1):
            want = sorted((repr(i), d, sign * w) for (i, _), d, w in zip(rows, deviations, columns[:, k], strict=True))
            if np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-9):
                break
        else:
            raise AssertionError(f"component {k + 1} differs")
        assert {r.explained for r in mine} == {mine[0].explained} and abs(mine[0].explained / explained[k] - 1) < 1e-9
    assert len({r.identity_error for r in found}) == 1 and 0 <= found[0].identity_error < 1e-9


def test_few_rows_lengths_and_large_entries(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 1.0]), (3, [5.0] * 40), (4, [1e300, 1.0]), (5, [3e16, 1.0]), (6, [-3e16, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {(r.vec_id, r.component): r for r in whitening.whitened(vectors).collect()}
    assert {i for i, _ in found} == {1, 2, 3, 5, 6} and len(found) == 3 + 3 + 32 + 2 + 2
    assert abs(abs(found[1, 1].whitened) - 1) < 1e-12 and found[1, 1].n == 2 and abs(found[1, 1].explained - 1) < 1e-12
    assert found[1, 2].whitened is None and found[1, 2].explained == 0
    assert found[3, 1].whitened is None and found[3, 1].explained is None and found[3, 1].identity_error is None
    assert found[3, 1].deviation == 0 and found[5, 1].deviation is None  # beyond a long
    assert found[1, 1].deviation == sum((2 * a - a - b) ** 2 for a, b in ((64, 128), (128, 128), (192, 64)))


def test_no_rows(spark):
    nothing = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    found = whitening.whitened(nothing)
    assert found.count() == 0
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_products_and_sums_by_task_add_up(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    one, many = (whitening.fit(vectors.repartition(k))[12] for k in (1, 7))
    assert one.rest == many.rest and (one.vectors == many.vectors).all() and (one.values == many.values).all()
