"""Row selection: levels, text, time-of-day windows, resume marks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.clock import leading_time, normal_time, with_leading_time
from tidelog.functions.text import file_instance

Window = tuple[str, str]


def error_rows(df: DataFrame, level: str = "log_type") -> DataFrame:
    return df.where(F.col(level) == "ERROR")


def filter_levels(df: DataFrame, levels: Iterable[str] = (), level: str = "log_type") -> DataFrame:
    """Keep the given levels; an empty set keeps every row."""
    wanted = list(levels)
    return df.where(F.col(level).isin(*wanted)) if wanted else df


def search(df: DataFrame, needle: str, levels: Iterable[str] = (), text: str = "log_message") -> DataFrame:
    """Rows whose text holds the needle literally, ignoring case, within levels."""
    wanted = needle.strip().lower()
    kept = filter_levels(df, levels)
    return kept.where(F.contains(F.lower(F.col(text)), F.lit(wanted))) if wanted else kept


def _in_order(df: DataFrame) -> DataFrame:
    return df.orderBy("tod", "file_name", "pos")


def time_window(
    lines: DataFrame, start: str, end: str, value: str = "value", separator: str = " ", ordered: bool = True
) -> DataFrame:
    """Lines whose leading time lies in ``[start, end]``, in time order.

    Equal times keep file and line order. Lines without a leading time are never
    selected; :func:`untimed` lists them.
    """
    timed = with_leading_time(lines, value, separator)
    chosen = timed.where(F.col("tod").between(normal_time(start), normal_time(end)))
    return _in_order(chosen) if ordered else chosen


def time_range(rows: DataFrame, start: str, end: str, ts: str = "event_ts") -> DataFrame:
    """Stored rows with an event time in ``[start, end]``.

    On the stored table the bounds reach its date partitions and, as plain
    comparisons, the row-group statistics of its time-ordered files.
    """
    lo, hi = [F.lit(bound).cast(rows.schema[ts].dataType) for bound in (start, end)]
    found = rows.where(F.col(ts).between(lo, hi))
    if "event_date" not in rows.columns:
        return found
    return found.where(F.col("event_date").between(*[b.cast("date").cast("string") for b in (lo, hi)]))


def untimed(lines: DataFrame, value: str = "value", separator: str = " ") -> DataFrame:
    """Lines that carry no valid leading time (for quarantine)."""
    return lines.where(leading_time(F.col(value), separator).isNull())


def normal_windows(windows: Sequence[Window]) -> list[Window]:
    """Configured windows in the form of times that :func:`leading_time` gives."""
    if not windows:
        raise ValueError("no time window configured")
    return [(normal_time(start), normal_time(end)) for start, end in windows]


def file_time_window(
    lines: DataFrame,
    windows: Sequence[Window],
    single: bool = False,
    value: str = "value",
    separator: str = " ",
    ordered: bool = True,
) -> DataFrame:
    """:func:`time_window` with the window configured for each line's file.

    ``single`` applies the first entry to all files; otherwise file
    ``output<n>.log`` uses entry ``n``, and a file without an entry fails the job.
    The list comes from a configuration file, so it is an array constant here and
    needs no join; the file's number is found once per line (see
    :func:`with_leading_time`).
    """
    bounds = normal_windows(windows)
    if single:
        return time_window(lines, *bounds[0], value, separator, ordered)
    once = F.inline(F.array(F.struct(file_instance(F.col("file_name")).alias("_nth"))))
    timed = with_leading_time(lines.select("*", once), value, separator)
    missing = F.raise_error(F.concat(F.lit("no time window for file "), F.col("file_name")))

    def bound(side: int) -> Column:
        known = F.array(*[F.lit(pair[side]) for pair in bounds])
        found = F.try_element_at(known, F.col("_nth"))
        return F.when(F.col("_nth").between(1, len(bounds)), found).otherwise(missing.cast("string"))

    chosen = timed.where((F.col("tod") >= bound(0)) & (F.col("tod") <= bound(1))).drop("_nth")
    return _in_order(chosen) if ordered else chosen


def resume_marks(selected: DataFrame) -> DataFrame:
    """Last published place of each file: greatest ``(tod, pos)``."""
    last = F.max(F.struct("tod", "pos"))
    return (
        selected.groupBy("file_name")
        .agg(last.alias("last"))
        .select("file_name", F.col("last.tod").alias("last_tod"), F.col("last.pos").alias("last_pos"))
    )


def resume_after_mark(
    lines: DataFrame,
    marks: DataFrame,
    windows: Sequence[Window],
    single: bool = False,
    value: str = "value",
    separator: str = " ",
    ordered: bool = True,
) -> DataFrame:
    """Lines of each file's window strictly after its mark.

    The window start still holds when the mark is older, and a file without a
    mark starts there. The marks have one row per file; their size decides
    whether the planner broadcasts them.
    """
    chosen = file_time_window(lines, windows, single, value, separator, ordered=False)
    after = (
        F.col("last_tod").isNull()
        | (F.col("tod") > F.col("last_tod"))
        | ((F.col("tod") == F.col("last_tod")) & (F.col("pos") > F.col("last_pos")))
    )
    rest = chosen.join(marks, "file_name", "left").where(after).drop("last_tod", "last_pos")
    return _in_order(rest) if ordered else rest


def first_rows(df: DataFrame, n: int = 15, order: Sequence[str] = ("event_ts", "log_id")) -> DataFrame:
    """First rows for display: a top-n per task and merge, not a full sort."""
    return df.orderBy(*order).limit(n)


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))


def table_view(df: DataFrame, with_file: bool = False) -> DataFrame:
    columns = ["timestamp", "log_type", "log_message"]
    return df.select(*columns, *(["file_name"] if with_file else []))
