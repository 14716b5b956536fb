"""Counts and profiles over log rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.levels import level_color, level_order
from tidelog.schema import (
    MAX_MESSAGE_LENGTH,
    MAX_SYMBOL,
    MESSAGE_PATTERN,
    MIN_MESSAGE_LENGTH,
    MIN_SYMBOL,
)


def level_counts(df: DataFrame, level: str = "log_type", order: str | None = None) -> DataFrame:
    """Rows per level present, with label and colour; ``order`` adds the first
    place each level is seen."""
    aggs = [F.count("*").alias("value")]
    if order:
        aggs.append(F.min(order).alias("first_seen"))
    return (
        df.groupBy(F.col(level).alias("id"))
        .agg(*aggs)
        .withColumn("label", F.col("id"))
        .withColumn("color", level_color(F.col("id")))
        .withColumn("ord", level_order(F.col("id")))
    )


def _share(hit: Column) -> Column:
    return F.avg(hit.cast("double"))


def pattern_rate(
    df: DataFrame, text: str = "log_message", pattern: str = MESSAGE_PATTERN, by: Sequence[str] = ()
) -> DataFrame:
    """How many rows hold the pattern, and their share, per group."""
    hit = F.coalesce(F.col(text).rlike(pattern), F.lit(False))
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_if(hit).alias("n_hits"), _share(hit).alias("hit_rate")
    )


def length_profile(
    df: DataFrame,
    text: str = "log_message",
    by: Sequence[str] = (),
    shortest: int = MIN_MESSAGE_LENGTH,
    longest: int = MAX_MESSAGE_LENGTH,
) -> DataFrame:
    """Length range and mean per group, with rows outside the limits and rows
    holding characters outside printable ASCII."""
    size = F.length(text)
    odd = F.col(text).rlike(f"[^\\x{MIN_SYMBOL:02X}-\\x{MAX_SYMBOL:02X}]")
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.min(size).alias("min_length"),
        F.max(size).alias("max_length"),
        F.avg(size).alias("avg_length"),
        F.count_if(~size.between(shortest, longest)).alias("n_bad_length"),
        F.count_if(odd).alias("n_bad_symbols"),
    )
