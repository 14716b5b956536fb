"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of D in an LDL' factorisation of a shifted matrix tell how many eigenvalues lie above
the shift (Sylvester's law of inertia). Such counts halve intervals until each holds one wanted
eigenvalue; Rayleigh quotient iteration then converges in a few steps, and counts on either
side of what it found certify its number. Eigenvalues that no interval can part share one, and
their vectors are kept apart by orthogonalisation.
"""

from __future__ import annotations

from math import sqrt

import numpy as np

#: Bound on the growth of entries that decides between pivots of one and of two rows.
PIVOT = (1 + sqrt(17)) / 8
EPS = float(np.finfo(float).eps)
#: Vectors whose eigenvalues are nearer than this share of the norm are orthogonalised.
CLOSE = 1e-3


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: the positive ones of D."""
    a = matrix - shift * np.eye(len(matrix))
    size, at, found = len(a), 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while at < size:
        own = abs(a[at, at])
        below = np.abs(a[at + 1 :, at])
        largest = below.max(initial=0.0)
        if largest == 0:  # nothing to eliminate
            found += a[at, at] > 0
            at += 1
            continue
        row = at + 1 + int(below.argmax())
        step = 1
        if own < PIVOT * largest:
            beside = np.abs(a[row, at:])
            beside[row - at] = 0
            widest = beside.max()
            if own * widest < PIVOT * largest**2:
                if abs(a[row, row]) >= PIVOT * widest:
                    swap(at, row)
                else:
                    swap(at + 1, row)
                    step = 2
        if step == 1:
            found += a[at, at] > 0
            column = a[at + 1 :, at].copy()
            a[at + 1 :, at + 1 :] -= np.outer(column, column / a[at, at])
        else:
            found += 1  # such a block has one eigenvalue of each sign
            block, columns = a[at : at + 2, at : at + 2], a[at + 2 :, at : at + 2].copy()
            (p, q), (_, r) = block
            inverse = np.array([[r, -q], [-q, p]]) / (p * r - q * q)
            a[at + 2 :, at + 2 :] -= columns @ inverse @ columns.T
        at += step
    return int(found)


class Slices:
    """Shifts with their counts; intervals between them are halved as they are needed."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        reach = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal())
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        edge = 4 * EPS * len(matrix) * self.norm
        low = float((matrix.diagonal() - reach).min()) - edge
        high = float((matrix.diagonal() + reach).max()) + edge
        self.counts = {low: len(matrix), high: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue of this number."""
        low = max(shift for shift, count in self.counts.items() if count >= number)
        return low, min(shift for shift, count in self.counts.items() if count < number and shift > low)

    def halve(self, number: int) -> bool:
        """Whether the interval of this number could be made narrower."""
        low, high = self.around(number)
        middle = (low + high) / 2
        if high - low <= 8 * EPS * self.norm or not low < middle < high:
            return False
        self.count(middle)
        return True

    def certified(self, value: float, margin: float, number: int) -> bool:
        """Whether the eigenvalue of this number lies within ``margin`` of ``value``."""
        return self.count(value + margin) < number <= self.count(value - margin)

    def alone(self, number: int) -> bool:
        low, high = self.around(number)
        return self.counts[low] - self.counts[high] == 1


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, norm: float) -> np.ndarray:
    size = len(matrix)
    for nudge in (0.0, EPS * norm, 4 * EPS * norm):
        try:
            found = np.linalg.solve(matrix - (shift + nudge) * np.eye(size), vector)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(found)
        if np.isfinite(length) and length > 0:
            return found / length
    return vector


def _clean(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``vector`` orthogonal to the columns ``others``, of length one."""
    for _ in range(2):
        vector = vector - others @ (others.T @ vector)
        vector = vector / np.linalg.norm(vector)
    return vector


def _refined(
    matrix: np.ndarray, start: np.ndarray, shift: float, norm: float, others: np.ndarray
) -> tuple[float, np.ndarray, float]:
    """Inverse iteration at ``shift``, then Rayleigh quotient iteration: value, vector, residual."""
    vector = _clean(start, others)
    for _ in range(3):
        vector = _clean(_solved(matrix, shift, vector, norm), others)
    best = (np.inf, 0.0, vector)
    for _ in range(12):
        image = matrix @ vector
        value = float(vector @ image)
        left = float(np.linalg.norm(image - value * vector))
        if left >= best[0]:
            break
        best = (left, value, vector)
        vector = _clean(_solved(matrix, value, vector, norm), others)
    left, value, vector = best
    return value, vector, left


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, that are not zero to rounding; unit vectors in columns.

    The matrix must have no eigenvalue clearly below zero. Each vector's largest entry is
    positive. An eigenvalue whose number its counts do not certify is an error.
    """
    size = len(matrix)
    slices = Slices(matrix)
    zero = 32 * EPS * size * slices.norm
    wanted = min(most, slices.count(zero)) if slices.norm > 0 else 0
    values: list[float] = []
    vectors = np.zeros((size, 0))
    starts = np.random.default_rng(1).standard_normal((size, wanted))
    for number in range(1, wanted + 1):
        while not slices.alone(number) and slices.halve(number):
            pass
        while True:
            low, high = slices.around(number)
            near = [i for i, value in enumerate(values) if value - low < CLOSE * slices.norm]
            value, vector, left = _refined(
                matrix, starts[:, number - 1], (low + high) / 2, slices.norm, vectors[:, near]
            )
            margin = 4 * EPS * size * slices.norm + left
            if low - margin <= value <= high + margin and slices.certified(value, margin, number):
                break
            if not slices.halve(number):
                if slices.certified(value, 64 * EPS * size * slices.norm, number):
                    break  # it has neighbours that rounding does not part
                raise ArithmeticError(f"counts do not certify {value} as eigenvalue {number}")
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    order = np.argsort(-np.array(values), kind="stable")
    vectors = vectors[:, order]
    if wanted:
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
        vectors = vectors * signs
    return np.array(values)[order], vectors
