"""Whitening of embeddings: rows projected on the leading components, each of variance one.

Three passes over the vectors give sums, products centred before they are multiplied, and the
whitened rows' own covariance; each task sends one sum per entry. Entries are whole numbers
after scaling, so sums are exact and do not depend on the order of tasks (products as long as
they stay under 2**53). Only tables of vector length by vector length reach the driver, where
spectrum slicing finds the components (see ``spectrum``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.spectrum import leading

#: An entry c counts as floor(SCALE * c) + OFFSET. What is computed here does not change with OFFSET,
#: so it is left out of the arithmetic.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Scaled entries from here on do not fit a long with OFFSET; they count as non-finite.
LARGEST = 2.0**62
LONG = 2**63 - 1


@dataclass
class Whitening:
    """What whitens vectors of one length."""

    n: int  #: vectors of the fit
    anchor: np.ndarray  #: whole numbers next to the means
    rest: list[int]  #: sums of the scaled entries less n times the anchor
    values: np.ndarray  #: eigenvalues, falling
    vectors: np.ndarray  #: unit eigenvectors, in columns
    trace: float
    count: int  #: components of a row, those without variance included

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """Scaled entries less their means."""
        return (whole - self.anchor) - np.array([t / self.n for t in self.rest])

    def whitened(self, whole: np.ndarray) -> np.ndarray:
        """One column per component with variance."""
        return self.centred(whole) @ self.vectors / np.sqrt(self.values)

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """Sums over entries of (n x - S)**2, exact; null beyond a long."""
        near = whole - self.anchor
        widest = self.n * int(np.abs(near).max(initial=0)) + max(map(abs, self.rest), default=0)
        if widest**2 * max(1, near.shape[1]) <= LONG:
            return ((self.n * near - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * x - t) ** 2 for x, t in zip(row, self.rest, strict=True)) for row in near.tolist()]
        return [value if value <= LONG else None for value in exact]


def whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, scaled whole entries) of the vectors that take part, for each length of vectors."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        flat = np.floor(SCALE * flat)
        bad = ~(np.abs(flat) < LARGEST)
    first = np.cumsum(lengths) - lengths
    spoiled = np.zeros(len(lengths), bool)
    spoiled[np.repeat(np.arange(len(lengths)), lengths)[bad]] = True
    for size in np.unique(lengths[~spoiled & (lengths > 0)]).tolist():
        rows = np.flatnonzero(~spoiled & (lengths == size))
        yield rows, flat[T.flat_ranges(first[rows], lengths[rows])].reshape(-1, size).astype(np.int64)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return whole_vectors(batch.column(batch.schema.get_field_index("vector_")))


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length: how many vectors, and the exact sum of each entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for _, whole in _vectors(batch):
                size = whole.shape[1]
                # high and low halves: neither sum leaves a long
                high, low = whole >> 31, whole & ((1 << 31) - 1)
                mine = [(int(h) << 31) + int(l) for h, l in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]
                counts[size] = counts.get(size, 0) + len(whole)
                totals[size] = [a + b for a, b in zip(totals.get(size, [0] * size), mine, strict=True)]
        keys = [(size, entry) for size in totals for entry in range(size)]
        yield pa.record_batch(
            {
                "size": pa.array([s for s, _ in keys], pa.int32()),
                "entry": pa.array([e for _, e in keys], pa.int32()),
                "n": pa.array([counts[s] for s, _ in keys], pa.int64()),
                "total": pa.array([Decimal(totals[s][e]) for s, e in keys], pa.decimal128(38, 0)),
            }
        )

    found = rows.select("vector_").mapInArrow(partial, "size int, entry int, n bigint, total decimal(38, 0)")
    found = found.groupBy("size", "entry").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    sums: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(found.collect()):  # one row for each entry of a vector
        sums.setdefault(row["size"], (row["n"], []))[1].append(int(row["total"]))
    return sums


def _products(
    rows: DataFrame, sizes: dict[int, int], prepared: Callable[[int, np.ndarray], np.ndarray]
) -> dict[int, np.ndarray]:
    """By length: the sum over vectors of the products of all pairs of entries of ``prepared``.

    ``sizes`` tells how many entries that has. A task sends one row for each pair of entries.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {size: np.zeros((width, width)) for size, width in sizes.items()}
        met = set()
        for batch in batches:
            for _, whole in _vectors(batch):
                size = whole.shape[1]
                own = prepared(size, whole)
                sums[size] += own.T @ own
                met.add(size)
        for size in met:
            i, j = np.triu_indices(sizes[size])
            yield pa.record_batch(
                {
                    "size": pa.array(np.full(len(i), size, np.int32)),
                    "i": pa.array(i.astype(np.int32)),
                    "j": pa.array(j.astype(np.int32)),
                    "total": pa.array(sums[size][i, j]),
                }
            )

    found = rows.select("vector_").mapInArrow(partial, "size int, i int, j int, total double")
    table = found.groupBy("size", "i", "j").agg(F.sum("total").alias("total")).toArrow()
    size, i, j, total = (table.column(n).to_numpy() for n in ("size", "i", "j", "total"))
    products = {one: np.zeros((width, width)) for one, width in sizes.items()}
    for one, matrix in products.items():
        mine = size == one
        matrix[i[mine], j[mine]] = matrix[j[mine], i[mine]] = total[mine]
    return products


def _exact(value: float) -> int | float:
    return int(value) if np.isfinite(value) else value


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """What whitens the vectors of each length that occurs (usually one)."""
    rows = _prepared(vectors, vector)
    sums = _sums(rows)
    anchors = {size: [(2 * t + n) // (2 * n) for t in totals] for size, (n, totals) in sums.items()}
    arrays = {size: np.array(anchor, np.int64) for size, anchor in anchors.items()}
    products = _products(
        rows, {size: size for size in sums}, lambda size, whole: (whole - arrays[size]).astype(np.float64)
    )
    models = {}
    for size, (n, totals) in sums.items():
        rest = [t - n * a for t, a in zip(totals, anchors[size], strict=True)]
        covariance = np.zeros((size, size))
        for i in range(size):
            for j in range(i, size):
                value = (n * _exact(products[size][i, j]) - rest[i] * rest[j]) / (n * n)
                covariance[i, j] = covariance[j, i] = value
        values, found = leading(covariance, components)
        trace = float(np.trace(covariance))
        models[size] = Whitening(n, arrays[size], rest, values, found, trace, min(components, size))
    return models


def identity_errors(vectors: DataFrame, models: dict[int, Whitening], vector: str = "embedding") -> dict[int, float | None]:
    """By length: the largest entry of the whitened vectors' covariance minus the identity."""
    with_one = {size: len(model.values) + 1 for size, model in models.items()}

    def own(size: int, whole: np.ndarray) -> np.ndarray:
        return np.column_stack([models[size].whitened(whole), np.ones(len(whole))])

    products = _products(_prepared(vectors, vector), with_one, own)
    errors: dict[int, float | None] = {}
    for size, model in models.items():
        mean = products[size][:-1, -1] / model.n
        off = products[size][:-1, :-1] / model.n - np.outer(mean, mean) - np.eye(len(mean))
        errors[size] = float(np.abs(off).max()) if off.size else None
    return errors


def _prepared(vectors: DataFrame, vector: str, *others: str) -> DataFrame:
    rows = vectors.where(F.col(vector).isNotNull())
    return rows.select(*[F.col(o).alias("id_") for o in others], F.col(vector).cast("array<double>").alias("vector_"))


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), one row per vector and component.

    Vectors that are null or empty, or hold a null, a non-finite entry or one whose scaled
    value no long holds, take no part. Vectors of different lengths are whitened apart, each
    length by its own fit. Repeated rows count and are returned as often as they occur, rows
    without id as well; other columns play no part; an empty table gives an empty table.

    A component without variance (more components than the vectors span) has a null
    ``whitened`` and explains nothing; where no vector varies, ``explained`` and
    ``identity_error`` are null. A ``deviation`` beyond a long is null. The driver and every task
    hold tables of vector length squared, a few for each length.
    """
    models = fit(vectors, vector, components)
    errors = identity_errors(vectors, models, vector) if models else {}
    kind = vectors.select(F.col(id_col)).schema[0].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id_"))
            for rows, whole in _vectors(batch):
                model = models[whole.shape[1]]
                count, known = model.count, len(model.values)
                flat = np.zeros((len(rows), count))
                flat[:, :known] = model.whitened(whole)
                lost = np.zeros(flat.shape, bool)
                lost[:, known:] = True
                explained = np.zeros(count)
                if model.trace > 0:
                    explained[:known] = model.values / model.trace
                many = len(rows)
                yield pa.record_batch(
                    {
                        "id_": ids.take(pa.array(np.repeat(rows, count))),
                        "component": pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), many)),
                        "n": pa.array(np.full(many * count, model.n, np.int64)),
                        "deviation": pa.array(model.deviations(whole), pa.int64()).take(
                            pa.array(np.repeat(np.arange(many), count))
                        ),
                        "whitened": pa.array(flat.ravel(), mask=lost.ravel()),
                        "explained": pa.array(
                            np.tile(explained, many), mask=np.full(many * count, not model.trace > 0)
                        ),
                        "identity_error": pa.array([errors[whole.shape[1]]] * (many * count), pa.float64()),
                    }
                )

    schema = (
        f"id_ {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    found = _prepared(vectors, vector, id_col).mapInArrow(project, schema)
    return found.withColumnRenamed("id_", id_col)
