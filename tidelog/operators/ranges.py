"""Closed value ranges: bucketing of values, nesting and overlap checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.schema import DEFAULT_LEVEL, LEVEL_RANGES
from tidelog.session import written_table

Range = tuple[str, float, float]


def range_bucket(value: Column, ranges: Sequence[Range] = LEVEL_RANGES, default: str = DEFAULT_LEVEL) -> Column:
    """Name of the first range, in ``(lo, hi)`` order, with ``lo <= value <= hi``.

    The ranges are configuration, so this is one generated CASE in the scan's own
    stage instead of a range join.
    """
    out = F.lit(default)
    for name, lo, hi in sorted(ranges, key=lambda r: (r[1], r[2]), reverse=True):
        out = F.when(value.between(lo, hi), F.lit(name)).otherwise(out)
    return out


def _sliced(points: DataFrame, lo: str) -> DataFrame:
    """Range-partition distinct points and keep the partition number as
    ``_slice``. Written out, so every later use sees the same cuts."""
    return written_table(
        points.repartitionByRange(lo).withColumn("_slice", F.spark_partition_id()), "range-starts"
    )


def nested_ranges(df: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Distinct ranges with what they collide with.

    ``is_nested``: another range holds this one whole (``other.lo <= lo`` and
    ``hi <= other.hi``). ``is_overlapping``: another range shares inner points
    with it (``other.lo < hi`` and ``lo < other.hi``). Pairs are not listed, as
    their number grows with the square of the input; the widest-reaching range
    that starts no later is given in ``reach_lo``, ``reach_hi`` instead (NULL if
    none), which is a container whenever there is one.

    Ranges are reduced to one row per start. A running maximum over the starts,
    first within slices of like size and then over the slices' totals, tells how far
    the earlier ranges reach.
    """
    ranges = df.select(F.col(lo).alias("lo"), F.col(hi).alias("hi")).where("lo IS NOT NULL AND hi IS NOT NULL")
    ranges = ranges.distinct()
    starts = ranges.groupBy("lo").agg(F.max("hi").alias("_far"), F.count_if(F.col("hi") > F.col("lo")).alias("_same"))
    cut = _sliced(starts, "lo")
    # Greatest reach first, then the smallest start: the same pick in any order.
    reach = F.struct(F.col("_far").alias("hi"), (-F.col("lo")).alias("neg_lo"))
    totals = cut.groupBy("_slice").agg(F.max(reach).alias("_total"), F.min("lo").alias("_lo"))
    by_slice = Window.orderBy("_slice")
    edges = totals.select(
        "_slice",
        F.max("_total").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.lead("_lo").over(by_slice).alias("_after"),
    )
    inside = Window.partitionBy("_slice").orderBy("lo")
    reached = (
        cut.join(edges, "_slice")
        .withColumn("_in", F.max(reach).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_next", F.coalesce(F.lead("lo").over(inside), F.col("_after")))
        .withColumn("_earlier", F.greatest("_before", "_in"))
        .select("lo", "_far", "_same", "_earlier", "_next")
    )
    joined = ranges.join(reached, "lo")
    own = F.when(F.col("_far") > F.col("hi"), F.struct(F.col("_far").alias("hi"), (-F.col("lo")).alias("neg_lo")))
    best = F.greatest(F.col("_earlier"), own)
    out = joined.withColumn("_best", best)
    nested = F.coalesce(F.col("_best.hi") >= F.col("hi"), F.lit(False))
    inner = F.col("lo") < F.col("hi")
    overlapping = (
        F.coalesce(F.col("_earlier.hi") > F.col("lo"), F.lit(False))
        | ((F.col("_same") > 1) & inner)
        | F.coalesce(F.col("_next") < F.col("hi"), F.lit(False))
    )
    return out.select(
        "lo",
        "hi",
        nested.alias("is_nested"),
        overlapping.alias("is_overlapping"),
        (-F.col("_best.neg_lo")).alias("reach_lo"),
        F.col("_best.hi").alias("reach_hi"),
    )
