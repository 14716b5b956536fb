"""Line positions across files, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidelog.functions.clock import event_time, floor_div
from tidelog.session import written_table

# Positions (bytes or rows) per block: rows of a block are ordered inside one task.
BLOCK = 1 << 20
# Blocks per stretch of the running sum over block sizes.
STRETCH = 1 << 12


def _blocked(df: DataFrame, pos: str, block: int) -> DataFrame:
    return df.withColumn("_block", floor_div(F.col(pos), block))


def line_numbers(
    df: DataFrame,
    file_name: str = "file_name",
    pos: str = "pos",
    name: str = "line_no",
    block: int = BLOCK,
    per_file: bool = False,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add the 0-based number of each row in ``(file, pos)`` order over all files,
    or starting anew in each file. Columns ``ties`` order rows of one position.

    Blocks of positions are counted first. A running sum over the counts, within
    stretches of blocks and then over the stretches, gives every block its first
    number, and rows are numbered inside their block. No task ever holds a file.
    The counts are written out, so the input is read once for them and once for
    the numbering.
    """
    blocked = _blocked(df, pos, block)
    counted = blocked.groupBy(file_name, "_block").agg(F.count("*").alias("_size"))
    sizes = written_table(counted.withColumn("_stretch", floor_div(F.col("_block"), STRETCH)), "block-sizes")
    totals = sizes.groupBy(file_name, "_stretch").agg(F.sum("_size").alias("_total"))

    def running(size: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    along = Window.partitionBy(file_name).orderBy("_stretch") if per_file else Window.orderBy(file_name, "_stretch")
    bases = totals.select(file_name, "_stretch", running("_total", along).alias("_base"))
    within = Window.partitionBy(file_name, "_stretch").orderBy("_block")
    firsts = sizes.withColumn("_part", running("_size", within)).join(bases, [file_name, "_stretch"])
    firsts = firsts.select(file_name, "_block", (F.col("_base") + F.col("_part")).alias("_first"))
    inside = Window.partitionBy(file_name, "_block").orderBy(pos, *ties)
    numbered = blocked.join(firsts, [file_name, "_block"])
    return numbered.withColumn(name, F.col("_first") + F.row_number().over(inside) - 1).drop("_first", "_block")


def consolidate(lines: DataFrame) -> DataFrame:
    """All lines of all files in file and line order."""
    return lines.orderBy("file_name", "pos")


def assign_dates(
    lines: DataFrame,
    first_day: str = "first_day",
    tod: str = "tod",
    file_name: str = "file_name",
    pos: str = "pos",
    block: int = BLOCK,
) -> DataFrame:
    """Add ``event_ts`` to lines that carry only a time of day.

    ``first_day`` is the date of a file's first line. The clock of a file goes
    back by more than twelve hours only at midnight, so each such step starts a
    day. Steps are found inside blocks of positions, and between the last line
    of a block and the first of the next, so a long file is never one group.
    """
    timed = _blocked(lines, pos, block)
    seconds = (
        F.substring(tod, 1, 2).cast("int") * 3600
        + F.substring(tod, 4, 2).cast("int") * 60
        + F.substring(tod, 7, 2).cast("int")
    )
    timed = timed.withColumn("_sec", seconds)
    half_day = 12 * 3600
    inside = Window.partitionBy(file_name, "_block").orderBy(pos)
    clocked = F.last("_sec", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    stepped = timed.withColumn("_step", F.when(clocked - F.col("_sec") > half_day, 1).otherwise(0))
    counted = stepped.withColumn("_days", F.sum("_step").over(inside.rowsBetween(Window.unboundedPreceding, 0)))

    with_clock = F.when(F.col("_sec").isNotNull(), F.struct(pos, "_sec"))
    edges = counted.groupBy(file_name, "_block").agg(
        F.min(with_clock)["_sec"].alias("_head"),
        F.max(with_clock)["_sec"].alias("_tail"),
        F.max("_days").alias("_inner"),
    )
    chain = Window.partitionBy(file_name).orderBy("_block")
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    linked = edges.withColumn(
        "_edge", F.when(F.last("_tail", ignorenulls=True).over(earlier) - F.col("_head") > half_day, 1).otherwise(0)
    )
    shifts = linked.select(
        file_name,
        "_block",
        (
            F.sum("_edge").over(chain.rowsBetween(Window.unboundedPreceding, 0))
            + F.coalesce(F.sum("_inner").over(earlier), F.lit(0))
        ).alias("_shift"),
    )
    dated = counted.join(shifts, [file_name, "_block"])
    day = F.date_add(F.col(first_day).cast("date"), (F.col("_shift") + F.col("_days")).cast("int"))
    return dated.withColumn("event_ts", event_time(day, F.col(tod))).drop(
        "_block", "_sec", "_step", "_days", "_shift"
    )
