"""Ranges that are data and many: lookup of values, innermost containers, containment counts.

No operator here lists pairs or meets a value with all ranges. Ranges (and values) are put in
slices of like size by range partitioning, each slice is worked on in order, and what a slice
must know of the others is one row per slice, or per pair of slices. A range over
everything, or very many ranges with one start or one end, is spread like any other rows:
slices are cut by start and end together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from tidelog.session import written_table

# Rows per slice, about. Pairs of slices stay fewer than the ranges up to 2^40 ranges.
SLICE_ROWS = 1 << 20

_EARLIER = (Window.unboundedPreceding, -1)


def _cut(rows: DataFrame, slices: int, order: Sequence[Column], name: str) -> DataFrame:
    """Keep the number of each row's slice; written out, so every use sees the same cuts."""
    cut = rows.repartitionByRange(slices, *order).withColumn(name, F.spark_partition_id())
    return written_table(cut, "range-slices")


def _slices(rows: int, slice_rows: int) -> int:
    return 1 + rows // slice_rows


def _nearest(rows: DataFrame, group: str, descending: bool, slice_rows: int) -> DataFrame:
    """Replace ``met`` of every asking row (those with none) by that of the nearest row that has
    one, at or before the asking row's ``at`` in the given direction and in its group.

    Two rows of a group that have one must not share their ``at``.
    """
    rows = written_table(rows.withColumn("_ask", F.col("met").isNull()), "asking-rows")
    along = F.desc("at") if descending else F.asc("at")
    cut = _cut(rows, _slices(rows.count(), slice_rows), [F.col(group), along, F.asc("_ask")], "_slice")
    pick = F.min_by if descending else F.max_by
    given = F.when(~F.col("_ask"), F.col("at"))
    tails = cut.groupBy(group, "_slice").agg(pick(F.col("met"), given).alias("_tail"))
    chain = Window.partitionBy(group).orderBy("_slice").rowsBetween(*_EARLIER)
    edges = tails.select(group, "_slice", F.last("_tail", ignorenulls=True).over(chain).alias("_before"))
    inside = Window.partitionBy(group, "_slice").orderBy(along, F.asc("_ask")).rowsBetween(*_EARLIER)
    found = cut.withColumn("_in", F.last("met", ignorenulls=True).over(inside)).where("_ask")
    joined = found.join(edges, [group, "_slice"])
    return joined.withColumn("met", F.coalesce("_in", "_before")).drop("_in", "_before", "_ask", "_slice")


def _first_choices(ranges: DataFrame, slice_rows: int) -> DataFrame:
    """Of distinct ranges ``(lo, hi, name)``, those that are anyone's first choice.

    In ``(lo, hi)`` order, a range comes first for the values beyond all ends before it. So only
    ranges that end later than all before them count, and a value's choice is the first of
    them that ends at it or later, if that one has begun.
    """
    ranges = written_table(ranges, "distinct-ranges")
    cut = _cut(ranges, _slices(ranges.count(), slice_rows), [F.col("lo"), F.col("hi")], "_slice")
    ends = cut.groupBy("_slice").agg(F.max("hi").alias("_end"))
    edges = ends.select("_slice", F.max("_end").over(Window.orderBy("_slice").rowsBetween(*_EARLIER)).alias("_before"))
    inside = Window.partitionBy("_slice").orderBy("lo", "hi").rowsBetween(*_EARLIER)
    reached = cut.withColumn("_in", F.max("hi").over(inside)).join(edges, "_slice")
    later = F.coalesce(F.col("hi") > F.greatest("_in", "_before"), F.lit(True))
    return reached.where(later).select("lo", "hi", "name")


def range_lookup(
    df: DataFrame,
    value: str,
    ranges: DataFrame,
    lo: str = "lo",
    hi: str = "hi",
    name: str = "name",
    out: str = "bucket",
    default: str = "other",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the name of the first range, in ``(lo, hi, name)`` order, with ``lo <= value <= hi``.

    As ``range_bucket``, for a table of ranges. Values without a range, and null values, get
    ``default``; ranges with a null bound or that end before they begin hold nothing. Every
    distinct value is looked up once, so a value held by a third of all rows costs no more than
    any other, and the rows get the answers by equality.
    """
    known = ranges.select(F.col(lo).alias("lo"), F.col(hi).alias("hi"), F.col(name).alias("name"))
    known = known.where("lo <= hi").groupBy("lo", "hi").agg(F.min("name").alias("name"))
    choices = _first_choices(known, slice_rows)
    one = F.lit(0).alias("_all")
    met = F.struct("lo", "name")
    given = choices.select(one, F.col("hi").alias("at"), met.alias("met"))
    asked = df.where(F.col(value).isNotNull()).select(F.col(value).alias("at")).distinct()
    asked = asked.select(one, "at", F.lit(None).cast(given.schema["met"].dataType).alias("met"))
    answers = _nearest(given.unionByName(asked), "_all", True, slice_rows)
    answers = answers.where(F.col("met.lo") <= F.col("at")).select(F.col("at").alias(value), F.col("met.name").alias(out))
    joined = df.join(answers, value, "left")
    return joined.select(*df.columns, F.coalesce(out, F.lit(default)).alias(out))


def _ranked(rows: DataFrame, slices: int, order: Sequence[Column], part: str, rank: str) -> DataFrame:
    """Add each row's slice and its 0-based place in ``order`` over all rows."""
    cut = _cut(rows, slices, order, part)
    sizes = cut.groupBy(part).agg(F.count("*").alias("_size"))
    first = F.coalesce(F.sum("_size").over(Window.orderBy(part).rowsBetween(*_EARLIER)), F.lit(0))
    numbered = cut.join(sizes.select(part, first.alias("_first")), part)
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return numbered.withColumn(rank, F.col("_first") + place - 1).drop("_first")


def _ordered(df: DataFrame, lo: str, hi: str, slice_rows: int) -> tuple[DataFrame, int, int]:
    """Distinct ranges with their places ``a_rank`` by ``(lo, -hi)`` and ``b_rank`` by ``(-hi, lo)``
    and the slices ``a``, ``b`` of both orders; the number of ranges; that of slices.

    One range holds another just if it comes first in both orders, and neither has ties.
    """
    ranges = df.select(F.col(lo).alias("lo"), F.col(hi).alias("hi")).where("lo IS NOT NULL AND hi IS NOT NULL")
    ranges = written_table(ranges.distinct(), "distinct-ranges")
    rows = ranges.count()
    slices = _slices(rows, slice_rows)
    by_start = _ranked(ranges, slices, [F.asc("lo"), F.desc("hi")], "a", "a_rank")
    by_end = _ranked(by_start, slices, [F.desc("hi"), F.asc("lo")], "b", "b_rank")
    ranked = written_table(by_end, "ordered-ranges")
    # as many as there are, which need not be as many as were asked for
    last = ranked.agg(F.max(F.greatest("a", "b"))).first()[0]
    return ranked, rows, 1 + (last or 0)


def _lower_before(place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row, the number of rows with a lower place (no two alike) and a lower key.

    Keys become ranks, of which the bits are read from the highest down: where two ranks part
    at a bit, the lower one has a zero there, so zeros before a one are counted among
    the ranks that agree in all higher bits.
    """
    rows = len(place)
    order = np.argsort(place)
    ranks = np.empty(rows, np.int64)
    # of equal keys the later one gets the lower rank, so that they never count
    ranks[np.lexsort((-np.arange(rows), key[order]))] = np.arange(rows)
    counts = np.zeros(rows, np.int64)
    for bit in range(max(rows - 1, 0).bit_length()):
        alike = np.argsort(ranks >> (bit + 1), kind="stable")
        higher = ranks[alike] >> (bit + 1)
        zero = (ranks[alike] >> bit) & 1 == 0
        until = np.concatenate(([0], np.cumsum(zero)))
        before = until[:-1] - until[np.searchsorted(higher, higher)]
        counts[alike[~zero]] += before[~zero]
    out = np.empty(rows, np.int64)
    out[order] = counts
    return out


def _counted(place: str, key: str, name: str) -> Callable[[pa.Table], pa.Table]:
    def count(rows: pa.Table) -> pa.Table:
        counts = _lower_before(rows[place].to_numpy(), rows[key].to_numpy())
        return rows.append_column(name, pa.array(counts, pa.int64()))

    return count


def container_counts(df: DataFrame, lo: str = "lo", hi: str = "hi", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Distinct ranges with ``n_around``, the number of other ranges that hold them, and
    ``n_inside``, the number of other ranges that they hold.

    Counting, not pairing: of the ranges before a range in both orders, those of its own slice by
    start, or else of its own slice by end, are counted in the slice, and those of
    neither by running sums over the counts of pairs of slices. What a range holds follows from
    its two places. Ranges with a null bound are left out.
    """
    ranked, rows, slices = _ordered(df, lo, hi, slice_rows)
    with_a = StructType([*ranked.schema.fields]).add("_in_a", LongType())
    by_a = ranked.groupBy("a").applyInArrow(_counted("a_rank", "b_rank", "_in_a"), with_a)
    with_b = StructType([*with_a.fields]).add("_in_b", LongType())
    by_b = by_a.groupBy("b").applyInArrow(_counted("b_rank", "a", "_in_b"), with_b)

    pairs = ranked.groupBy("a", "b").agg(F.count("*").alias("_size"))
    grid = pairs.select("a").distinct().select("a", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("b"))
    grid = grid.join(pairs, ["a", "b"], "left").fillna(0, ["_size"])
    grid = grid.withColumn("_row", F.sum("_size").over(Window.partitionBy("a").orderBy("b").rowsBetween(*_EARLIER)))
    below = F.sum("_row").over(Window.partitionBy("b").orderBy("a").rowsBetween(*_EARLIER))
    beyond = grid.select("a", "b", F.coalesce(below, F.lit(0)).alias("_beyond"))

    around = F.col("_in_a") + F.col("_in_b") + F.col("_beyond")
    counted = by_b.join(beyond, ["a", "b"]).withColumn("n_around", around)
    inside = F.lit(rows - 1) - F.col("a_rank") - F.col("b_rank") + F.col("n_around")
    return counted.select("lo", "hi", "n_around", inside.cast("bigint").alias("n_inside"))


def _last_lower(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the last row before it with a lower key, or -1; and which rows are lower
    than all after them."""
    found = np.full(len(keys), -1, np.int64)
    stack: list[int] = []
    for row, key in enumerate(keys.tolist()):
        while stack and keys[stack[-1]] > key:
            stack.pop()
        if stack:
            found[row] = stack[-1]
        stack.append(row)
    left = np.zeros(len(keys), bool)
    left[stack] = True
    return found, left


def _linked(lowest: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """A slice's ranges with the container found in the slice, else the slice that has it.
    ``lowest`` is the lowest ``b_rank`` of every slice."""

    def link(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("a_rank")
        keys = rows["b_rank"].to_numpy()
        found, left = _last_lower(keys)
        own = rows["a"][0].as_py()
        backwards = np.minimum.accumulate(lowest[:own][::-1])
        # the first of a falling sequence that is lower than the key
        back = np.searchsorted(-backwards, -keys, side="right")
        elsewhere = (found < 0) & (back < own)
        up = pa.array(found, mask=found < 0)
        columns = {name: rows[name] for name in ("lo", "hi", "a", "a_rank", "b_rank")}
        columns |= {"up_lo": rows["lo"].take(up), "up_hi": rows["hi"].take(up), "up_rank": rows["a_rank"].take(up)}
        columns |= {"target": pa.array(own - 1 - back, pa.int64(), mask=~elsewhere), "open": pa.array(left)}
        return pa.table(columns)

    return link


def _depths(links: DataFrame) -> DataFrame:
    """``(a_rank, depth)``: links to the outermost container, by doubling the reach of every link
    until all have ended: as many rounds as the depth has binary digits."""
    nothing = F.lit(0).cast("bigint")
    done = links.where("up_rank IS NULL").select("a_rank", nothing.alias("depth"))
    going = links.where("up_rank IS NOT NULL").select("a_rank", "up_rank", (nothing + 1).alias("depth"))
    going = written_table(going, "container-links")
    while going.limit(1).count():
        above = going.select(F.col("a_rank").alias("up_rank"), F.col("up_rank").alias("_up"), F.col("depth").alias("_more"))
        ended = done.select(F.col("a_rank").alias("up_rank"), F.lit(None).cast("bigint").alias("_up"), F.col("depth").alias("_more"))
        moved = going.join(above.unionByName(ended), "up_rank")
        moved = moved.select("a_rank", F.col("_up").alias("up_rank"), (F.col("depth") + F.col("_more")).alias("depth"))
        moved = written_table(moved, "container-links")
        done = done.unionByName(moved.where("up_rank IS NULL").select("a_rank", "depth"))
        going = moved.where("up_rank IS NOT NULL")
    return done


def innermost_containers(df: DataFrame, lo: str = "lo", hi: str = "hi", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Distinct ranges with their innermost container ``up_lo``, ``up_hi`` and ``depth``.

    Of the other ranges that hold a range, the innermost one starts last and, of those, ends first
    (NULL if there is none). The links make a forest; ``depth`` is the number of links to its
    root. Inside a slice by start a stack finds the container. Else the lowest places of
    the slices (one number for each, the only thing the driver holds) tell which slice has
    it, and there it is among the ranges that no later one of the slice outreaches: the one
    nearest by end. Ranges with a null bound are left out.
    """
    ranked, _, slices = _ordered(df, lo, hi, slice_rows)
    lowest = np.full(slices, np.iinfo(np.int64).max)
    for part, low in ranked.groupBy("a").agg(F.min("b_rank")).collect():
        lowest[part] = low
    kinds = {field.name: field.dataType for field in ranked.schema}
    schema = StructType()
    for name in ("lo", "hi", "a", "a_rank", "b_rank"):
        schema.add(name, kinds[name])
    schema.add("up_lo", kinds["lo"]).add("up_hi", kinds["hi"]).add("up_rank", LongType())
    schema.add("target", LongType()).add("open", BooleanType())
    linked = written_table(ranked.groupBy("a").applyInArrow(_linked(lowest), schema), "linked-ranges")

    itself = F.struct(F.col("lo"), F.col("hi"), F.col("a_rank").alias("rank"))
    at = F.col("b_rank").alias("at")
    given = linked.where("open").select(F.col("a").cast("bigint").alias("part"), at, itself.alias("met"), "lo", "hi", "a_rank")
    nothing = F.lit(None).cast(given.schema["met"].dataType).alias("met")
    asked = linked.where("target IS NOT NULL").select(F.col("target").alias("part"), at, nothing, "lo", "hi", "a_rank")
    met = _nearest(given.unionByName(asked), "part", False, slice_rows)
    columns = ["lo", "hi", "a_rank"]
    far = met.select(
        *columns, F.col("met.lo").alias("up_lo"), F.col("met.hi").alias("up_hi"), F.col("met.rank").alias("up_rank")
    )
    near = linked.where("target IS NULL").select(*columns, "up_lo", "up_hi", "up_rank")
    links = written_table(near.unionByName(far), "container-links")
    return links.join(_depths(links), "a_rank").select("lo", "hi", "up_lo", "up_hi", "depth")
