import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.operators.intervals import _lower_before, container_counts, innermost_containers, range_lookup

KINDS = ("mixed", "nested", "staggered", "one start", "one end", "disjoint")


def made(kind, seed, rows=90):
    rng = random.Random(f"{kind}{seed}")
    if kind == "mixed":
        return [(float(lo), float(lo + rng.choice([0, 0, 1, 2, 5, 30]))) for lo in [rng.randrange(60) for _ in range(rows)]]
    if kind == "nested":
        return [(float(k), float(3 * rows - k)) for k in range(rows)]
    if kind == "staggered":
        return [(float(k), float(k + 7)) for k in range(rows)] + [(-1.0, 1e9)]
    if kind == "one start":
        return [(0.0, float(rng.randrange(500))) for _ in range(rows)]
    if kind == "one end":
        return [(float(rng.randrange(500)), 500.0) for _ in range(rows)]
    return [(10.0 * k, 10.0 * k + 4) for k in range(rows)]


def holders(r, known):
    return [o for o in known if o != r and o[0] <= r[0] and r[1] <= o[1]]


@pytest.mark.parametrize("seed", range(5))
def test_lower_before_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    rows = int(rng.integers(0, 200))
    place, key = rng.permutation(rows) * 3, rng.integers(0, max(rows // (seed + 1), 1), rows)
    want = [int(((place < p) & (key < k)).sum()) for p, k in zip(place, key)]
    assert _lower_before(place, key).tolist() == want


@pytest.mark.parametrize("slice_rows", [13, 1 << 20])
@pytest.mark.parametrize("kind", KINDS)
def test_containers_against_all_pairs(spark, kind, slice_rows):
    spans = made(kind, 1)
    df = spark.createDataFrame([*spans, *spans[:9], (None, 1.0), (1.0, None)], "lo double, hi double")
    known = set(spans)
    counted = container_counts(df, slice_rows=slice_rows).collect()
    assert {(r.lo, r.hi) for r in counted} == known and len(counted) == len(known)
    around = {r: holders(r, known) for r in known}
    for r in counted:
        inside = sum((r.lo, r.hi) in held for held in around.values())
        assert (r.n_around, r.n_inside) == (len(around[r.lo, r.hi]), inside), r

    linked = innermost_containers(df, slice_rows=slice_rows).collect()
    assert {(r.lo, r.hi) for r in linked} == known and len(linked) == len(known)
    up = {r: max(held, key=lambda o: (o[0], -o[1]), default=None) for r, held in around.items()}
    for r in linked:
        want = up[r.lo, r.hi]
        assert (r.up_lo, r.up_hi) == (want or (None, None)), r
        depth = 0
        while want:
            depth, want = depth + 1, up[want]
        assert r.depth == depth, r


@pytest.mark.parametrize("slice_rows", [13, 1 << 20])
@pytest.mark.parametrize("kind", KINDS)
def test_lookup_against_all_pairs(spark, kind, slice_rows):
    rng = random.Random(kind)
    spans = made(kind, 2)
    named = [(lo, hi, f"r{rng.randrange(40)}") for lo, hi in [*spans, *spans[:9]]]
    odd = [(None, 5.0, "a"), (5.0, None, "a"), (9.0, 3.0, "a")]
    # a third of the rows hold one value, others lie on and between the bounds and outside
    values = [7.0] * 100 + [rng.choice(spans)[rng.randrange(2)] + rng.choice([0, 0, 0.5, -0.5]) for _ in range(200)]
    values += [None, -1e6, 1e12]
    df = spark.createDataFrame(list(enumerate(values)), "lo long, v double")
    ranges = spark.createDataFrame(named + odd, "lo double, hi double, name string")
    got = {r.lo: r.bucket for r in range_lookup(df, "v", ranges, slice_rows=slice_rows).collect()}
    assert len(got) == len(values)
    for number, value in enumerate(values):
        fits = [r for r in named if value is not None and r[0] <= value <= r[1]]
        assert got[number] == (min(fits)[2] if fits else "other"), (number, value)


def test_no_ranges_and_no_values(spark):
    empty = spark.createDataFrame([], "lo double, hi double, name string")
    assert container_counts(empty).count() == innermost_containers(empty).count() == 0
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert [r.bucket for r in range_lookup(df, "v", empty).collect()] == ["other"] * 2
    assert range_lookup(df.limit(0), "v", empty).count() == 0


def test_containers_of_dates(spark):
    df = spark.range(40).select(
        F.expr("date_add(DATE'2024-01-01', int(id % 7))").alias("since"),
        F.expr("date_add(DATE'2024-01-01', int(id % 7 + id % 5))").alias("until"),
    )
    known = {tuple(r) for r in df.collect()}
    counted = container_counts(df, "since", "until", slice_rows=5).collect()
    assert {(r.lo, r.hi): r.n_around for r in counted} == {r: len(holders(r, known)) for r in known}
