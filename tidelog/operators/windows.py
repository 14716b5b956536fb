"""Fixed windows and per-window series of level counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.levels import level_color, level_order
from tidelog.schema import DASHBOARD_LEVELS


def epoch_window(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned window of a given number of seconds."""
    return F.window(ts, f"{int(seconds)} seconds")["start"]


def tumbling_count(
    df: DataFrame, seconds: int, level: str | None = None, ts: str = "event_ts", level_column: str = "log_type"
) -> DataFrame:
    """Rows per epoch-aligned window; windows without rows do not appear."""
    kept = df if level is None else df.where(F.col(level_column) == level)
    return (
        kept.groupBy(F.window(ts, f"{int(seconds)} seconds").alias("_w"))
        .agg(F.count("*").alias("n_logs"))
        .select(F.col("_w.start").alias("window_start"), "n_logs")
    )


def level_series(
    labelled: DataFrame,
    keys: Sequence[str] = (),
    levels: Iterable[str] = DASHBOARD_LEVELS,
    level: str = "log_type",
    window_idx: str = "window_idx",
) -> DataFrame:
    """One row per window and level with the number of rows, zeros included.

    All levels of a window are counted side by side in one aggregation and then
    unfolded, so the dense grid needs neither a grid table nor a join.
    """
    wanted = list(levels)
    counts = [F.count_if(F.col(level) == name).alias(f"_n{i}") for i, name in enumerate(wanted)]
    wide = labelled.groupBy(*keys, window_idx).agg(*counts)
    points = F.array(
        *[F.struct(F.lit(name).alias("level"), F.col(f"_n{i}").alias("y")) for i, name in enumerate(wanted)]
    )
    long = wide.select(*keys, window_idx, F.inline(points))
    return long.select(
        *keys,
        F.col(window_idx),
        level_order(F.col("level")).alias("ord"),
        "level",
        level_color(F.col("level")).alias("color"),
        F.col(window_idx).cast("string").alias("x"),
        "y",
    )


def chart_series(series: DataFrame, keys: Sequence[str] = (), window_idx: str = "window_idx") -> DataFrame:
    """Nested form for a line chart: per level the list of ``{x, y}`` in window
    order. One list per level has one entry per window, not per row."""
    point = F.struct(F.col(window_idx), F.col("x"), F.col("y"))
    listed = series.groupBy(*keys, F.col("level").alias("id"), "color").agg(
        F.sort_array(F.collect_list(point)).alias("_points")
    )
    data = F.transform("_points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return listed.select(*keys, "id", "color", data.alias("data"))
