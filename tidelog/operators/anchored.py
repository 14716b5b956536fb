"""Event-anchored windows.

The first event opens a window of fixed length; later events up to and including
its end belong to it; the first event after the end opens the next window, at its
own time. Each opening depends on the one before, so this is a chain, and neither
``window()`` nor ``session_window()`` can express it.

A key of few distinct times is one streamed pass over them in order. A key of many
is cut by its data, not by its clock:

1. Distinct times, and the window end each would have as an opening, are put in
   slices of equal size, however crowded an hour is. Inside a slice a running value
   gives every end the first time after it; ends past a slice's last time take the
   next slice's first one. So every time knows its follower.
2. Cells of one window length hold one opening at most. Neighbouring cells are joined
   to blocks of 2, 4, 8 ... cells. A window reaches a block from outside in its first
   cell or opens at its first time, so only these times matter there: the tables
   "time -> first opening beyond the block, openings until then" halve from level to
   level, and each comes from the one before by one equality join.
3. Where few times are left, one streamed pass follows the chain over whole blocks. On
   the way back each level tells the opening in the second half of every block that was
   entered in its first half, down to the cells.
4. Two openings are more than a window length apart, so a time cell of that length
   holds at most one, and rows of a cell belong either to it or to the window that
   reaches in from the cell before. Rows find their window by an equality join on
   the cell.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidelog.functions.clock import floor_div, from_micros, micros
from tidelog.session import written_table

# Distinct times of a key that one task streams through, and rows of a slice of larger keys.
STREAM_ROWS = 1 << 20
SLICE_ROWS = 1 << 20

MINUTE = 60_000_000
_BEFORE_ALL, _AFTER_ALL = int(np.iinfo(np.int64).min), int(np.iinfo(np.int64).max)
_FLUSH_ROWS = 1 << 16

Batches = Iterator[pa.RecordBatch]


def _pieces(batches: Batches, keys: Sequence[str], values: Sequence[str]) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """Runs of equal keys in sorted batches, each with its value arrays. A run that
    goes on in the next batch comes as several pieces; ``groupby`` joins them
    without holding them."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        names = [batch.column(name) for name in keys]
        arrays = [batch.column(name).to_numpy() for name in values]
        change = np.ones(rows, dtype=bool)
        change[1:] = False
        for column in names:
            change[1:] |= pc.not_equal(column.slice(1), column.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(change)
        for lo, hi in zip(starts, np.append(starts[1:], rows)):
            yield tuple(column[lo].as_py() for column in names), [array[lo:hi] for array in arrays]


def _packed(parts: Iterable[pa.RecordBatch]) -> Batches:
    """Join small batches to ones worth sending."""
    waiting, rows = [], 0
    for part in parts:
        waiting.append(part)
        rows += part.num_rows
        if rows >= _FLUSH_ROWS:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, rows = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def _columns(k: str, rows: int, **columns: object) -> pa.RecordBatch:
    """A batch of one key's rows; single numbers are repeated."""
    arrays = [pa.repeat(pa.scalar(k, pa.string()), rows)]
    for values in columns.values():
        arrays.append(pa.array(np.broadcast_to(np.asarray(values, dtype=np.int64), rows)))
    return pa.RecordBatch.from_arrays(arrays, names=["k", *columns])


def _openings(length: int):
    """Rows sorted by (k, us), each with the state that enters its key, to the openings."""

    def found(batches: Batches) -> Batches:
        pieces = _pieces(batches, ["k"], ["us", "in_until", "in_idx"])
        for (k,), parts in groupby(pieces, key=lambda p: p[0]):
            until = idx = None
            for _, (times, in_until, in_idx) in parts:
                if until is None:
                    until, idx = int(in_until[0]), int(in_idx[0])
                opened = []
                at = int(np.searchsorted(times, until, side="right"))
                while at < len(times):
                    opened.append(int(times[at]))
                    until = opened[-1] + length
                    at = int(np.searchsorted(times, until, side="right"))
                if opened:
                    yield _columns(k, len(opened), window_idx=idx + np.arange(len(opened)), us=opened)
                    idx += len(opened)

    return lambda batches: _packed(found(batches))


def _followed(batches: Batches) -> Batches:
    """Rows sorted by (k, us), each with its follower, the openings until there and the
    number its key starts with, to the rows on the way from each key's first row."""

    def found() -> Batches:
        pieces = _pieces(batches, ["k"], ["us", "nxt", "steps", "in_idx"])
        for (k,), parts in groupby(pieces, key=lambda p: p[0]):
            goal = idx = None
            for _, (us, nxt, steps, in_idx) in parts:
                if goal is None:
                    goal, idx = int(us[0]), int(in_idx[0])
                met = []
                at = int(np.searchsorted(us, goal))
                while at < len(us) and us[at] == goal:
                    met.append((idx, goal))
                    goal, idx = int(nxt[at]), idx + int(steps[at])
                    at = int(np.searchsorted(us, goal))
                if met:
                    numbers, starts = zip(*met)
                    yield _columns(k, len(met), window_idx=numbers, us=starts)

    return _packed(found())


def _key(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*keys)) if keys else F.lit("")


def _length(minutes: float) -> int:
    length = round(minutes * MINUTE)
    if length <= 0:
        raise ValueError("a window needs a positive length")
    return length


_OPENINGS = "k string, window_idx bigint, us bigint"


def window_openings(
    df: DataFrame,
    ts: str = "event_ts",
    minutes: float = 1,
    keys: Sequence[str] = (),
    carried: DataFrame | None = None,
) -> DataFrame:
    """Openings ``(k, window_idx, us)`` of every key's windows, one row per window.

    ``carried`` (``k, start, idx``) gives the window a key has open already; rows
    up to its end must have been taken out before.
    """
    length = _length(minutes)
    times = df.where(F.col(ts).isNotNull()).select(_key(keys).alias("k"), micros(df, ts).alias("us"))
    times = written_table(times.distinct(), "times")
    if carried is not None:
        carried = carried.select("k", (F.col("start") + length).alias("in_until"), (F.col("idx") + 1).alias("in_idx"))
    if times.count() <= STREAM_ROWS:
        return _streamed(times, length, carried)
    crowded = times.groupBy("k").count().where(F.col("count") > STREAM_ROWS).select("k")
    crowded = written_table(crowded, "crowded-keys")
    if not crowded.limit(1).count():
        return _streamed(times, length, carried)
    few = _streamed(times.join(crowded, "k", "left_anti"), length, carried)
    return few.unionByName(_doubled(times.join(crowded, "k", "left_semi"), length, carried))


def _entered(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Rows with the end and the next number that their key comes with."""
    none = {"in_until": _BEFORE_ALL, "in_idx": 0}
    if carried is None:
        return rows.select("*", *[F.lit(v).cast("bigint").alias(n) for n, v in none.items()])
    return rows.join(carried, "k", "left").fillna(none)


def _streamed(times: DataFrame, length: int, carried: DataFrame | None) -> DataFrame:
    rows = _entered(times, carried).select("k", "us", "in_until", "in_idx")
    return rows.repartition("k").sortWithinPartitions("k", "us").mapInArrow(_openings(length), _OPENINGS)


def _followers(times: DataFrame, length: int) -> DataFrame:
    """``(k, us, nxt)``: every time with the first one after the window it would open."""
    data = times.select("k", F.col("us").alias("at"), F.lit(0).alias("ask"))
    asks = times.select("k", (F.col("us") + length).alias("at"), F.lit(1).alias("ask"))
    slices = 1 + 2 * times.count() // SLICE_ROWS
    cut = data.unionByName(asks).repartitionByRange(slices, "k", "at", "ask")
    cut = written_table(cut.withColumn("_slice", F.spark_partition_id()), "time-slices")
    time = F.when(F.col("ask") == 0, F.col("at"))

    def later(value: Column, window: WindowSpec) -> Column:
        """The nearest value among later rows: the window runs backwards."""
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    edges = cut.groupBy("k", "_slice").agg(F.min(time).alias("_head"))
    backwards = Window.partitionBy("k").orderBy(F.desc("_slice"))
    edges = edges.select("k", "_slice", later(F.col("_head"), backwards).alias("_after"))
    # of a time and a window end that are equal, the end comes last: the time is in the window
    inside = Window.partitionBy("k", "_slice").orderBy(F.desc("at"), F.desc("ask"))
    found = cut.withColumn("_in", later(time, inside)).where("ask = 1").join(edges, ["k", "_slice"])
    return found.select("k", (F.col("at") - length).alias("us"), F.coalesce("_in", "_after").alias("nxt"))


def _doubled(times: DataFrame, length: int, carried: DataFrame | None) -> DataFrame:
    """Openings of keys with very many times."""
    times = written_table(times, "crowded-times")
    origin = written_table(times.groupBy("k").agg(F.min("us").alias("_first")), "first-times")
    rows = _followers(times, length).join(origin, "k")
    cells = [floor_div(F.col(of) - F.col("_first"), length).alias(name) for of, name in (("us", "cell"), ("nxt", "ncell"))]
    one = F.lit(1).cast("bigint").alias("steps")
    levels = [written_table(rows.select("k", "us", "nxt", *cells, one), "followers")]

    def block(cell: str, level: int) -> Column:
        return F.shiftright(cell, level)

    def goes(level: int) -> Column:
        """Whether a row in the first half of its block has its follower in the second."""
        return (block("cell", level) % 2 == 0) & (block("ncell", level) == block("cell", level) + 1)

    last_cell = levels[0].agg(F.max("cell")).first()[0]
    while last_cell >> (len(levels) - 1):
        level, rows = len(levels) - 1, levels[-1]
        if rows.groupBy("k").count().agg(F.max("count")).first()[0] <= STREAM_ROWS:
            break
        second = block("cell", level) % 2 == 1
        heads = rows.where(second).groupBy("k", block("cell", level).alias("_block"))
        heads = heads.agg(F.min(F.struct("us", "nxt", "cell", "ncell", "steps")).alias("_r")).select("k", "_r.*")
        kept = rows.where(~second).unionByName(heads)
        beyond = rows.where(second).select(
            "k", F.col("us").alias("nxt"), F.col("nxt").alias("_nxt"), F.col("ncell").alias("_ncell"), F.col("steps").alias("_steps")
        )
        jumped = kept.where(goes(level)).join(beyond, ["k", "nxt"])
        jumped = jumped.select(
            "k", "us", F.col("_nxt").alias("nxt"), "cell", F.col("_ncell").alias("ncell"), (F.col("steps") + F.col("_steps")).alias("steps")
        )
        stays = kept.where(~F.coalesce(goes(level), F.lit(False)))
        levels.append(written_table(stays.unionByName(jumped), "followers"))

    top = _entered(levels.pop(), carried).withColumn("nxt", F.coalesce("nxt", F.lit(_AFTER_ALL)))
    top = top.select("k", "us", "nxt", "steps", "in_idx").repartition("k").sortWithinPartitions("k", "us")
    entries = written_table(top.mapInArrow(_followed, _OPENINGS), "entries")
    for level in reversed(range(len(levels))):
        through = levels[level].where(goes(level)).join(entries, ["k", "us"])
        reached = through.select("k", (F.col("window_idx") + F.col("steps")).alias("window_idx"), F.col("nxt").alias("us"))
        entries = written_table(entries.unionByName(reached), "entries")
    return entries


def _labelled(df: DataFrame, opened: DataFrame, ts: str, length: int, keys: Sequence[str]) -> DataFrame:
    """Rows with number and start (``_idx``, ``_start``) of the window they are in."""
    reach = F.struct(F.col("us"), F.col("window_idx").alias("idx"))
    none = F.lit(None).cast("struct<us:bigint,idx:bigint>")
    cell = floor_div(F.col("us"), length)
    cells = (
        opened.select(
            F.col("k").alias("_k"),
            F.inline(
                F.array(
                    F.struct(cell.alias("_cell"), reach.alias("_own"), none.alias("_prior")),
                    F.struct((cell + 1).alias("_cell"), none.alias("_own"), reach.alias("_prior")),
                )
            ),
        )
        .groupBy("_k", "_cell")
        .agg(F.max("_own").alias("_own"), F.max("_prior").alias("_prior"))
    )
    placed = df.withColumn("_k", _key(keys)).withColumn("_us", micros(df, ts))
    joined = placed.withColumn("_cell", floor_div(F.col("_us"), length)).join(cells, ["_k", "_cell"], "left")
    mine = F.when(F.col("_us") >= F.col("_own.us"), F.col("_own")).otherwise(F.col("_prior"))
    found = joined.withColumn("_w", mine)
    return found.select(*df.columns, F.col("_w.idx").alias("_idx"), F.col("_w.us").alias("_start"))


def _shown(df: DataFrame, labelled: DataFrame, ts: str, length: int, *more: str) -> DataFrame:
    ended = labelled.withColumn("_end", F.col("_start") + F.lit(length))
    return ended.select(
        *df.columns,
        F.col("_idx").alias("window_idx"),
        from_micros(df, ts, "_start").alias("window_start"),
        from_micros(df, ts, "_end").alias("window_end"),
        *more,
    )


def anchored_windows(
    df: DataFrame, ts: str = "event_ts", minutes: float = 1, keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``window_idx`` (from 0 per key), ``window_start`` and ``window_end``.

    ``keys`` gives each key its own chain; without keys there is one chain over
    all rows. Rows without a time get no window. The openings are computed and
    written first: there is at most one per window length of time and key, and
    their true size then decides how the rows' join runs.
    """
    length = _length(minutes)
    opened = written_table(window_openings(df, ts, minutes, keys), "openings")
    return _shown(df, _labelled(df, opened, ts, length, keys), ts, length)


CARRIED = "k string, start bigint, idx bigint"


def resumed_windows(
    df: DataFrame,
    carried: DataFrame,
    ts: str = "event_ts",
    minutes: float = 1,
    keys: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """:func:`anchored_windows` going on from the windows still open.

    ``carried`` has a row ``(k, start, idx)`` per key seen before. A row not after
    the end of its key's open window joins it, however old it is; ``is_late`` marks
    rows older than that window's start. Gives the labelled rows and the new
    ``carried``.
    """
    length = _length(minutes)
    known = carried.select(F.col("k").alias("_k"), F.col("start").alias("_start"), F.col("idx").alias("_idx"))
    placed = df.withColumn("_k", _key(keys)).withColumn("_us", micros(df, ts)).join(known, "_k", "left")
    in_open = F.coalesce(F.col("_us") <= F.col("_start") + length, F.lit(False))
    rest = placed.where(~in_open).select(*df.columns)
    opened = written_table(window_openings(rest, ts, minutes, keys, carried), "openings")
    fresh = _labelled(rest, opened, ts, length, keys).withColumn("is_late", F.lit(False))
    joined = placed.where(in_open).select(
        *df.columns, "_idx", "_start", (F.col("_us") < F.col("_start")).alias("is_late")
    )
    last = opened.select("k", F.col("us").alias("start"), F.col("window_idx").alias("idx")).unionByName(carried)
    newest = last.groupBy("k").agg(F.max("idx").alias("idx"), F.max("start").alias("start"))
    return _shown(df, fresh.unionByName(joined), ts, length, "is_late"), newest.select("k", "start", "idx")
