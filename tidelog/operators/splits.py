"""Positional splits of a table into a test part and a base part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.clock import floor_div
from tidelog.operators.positions import line_numbers


def _overall(df: DataFrame, pos: str, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based number of each row in ``pos`` order."""
    return line_numbers(df.withColumn("_all", F.lit(0)), "_all", pos, name, ties=ties).drop("_all")


def holdout_split(
    df: DataFrame, user: str, pos: str, start: int, stop: int, max_test: int = 0
) -> DataFrame:
    """Add ``is_test``: rows number ``start`` to ``stop`` of each user in ``pos``
    order, and of those only the first ``max_test`` overall (0 = no limit).

    Rows of a user at one position are ordered by a hash of their other columns, those of
    several users by user; rows equal in all columns are alike. A user with very many rows costs
    no more than any other: rows are numbered in blocks of positions. Rows without user or
    position are never test rows.
    """
    others = [c for c in df.columns if c not in (user, pos)]
    tied = df.withColumn("_tie", F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0))
    named = tied.where(F.col(user).isNotNull() & F.col(pos).isNotNull())
    numbered = line_numbers(named, user, pos, "_n", per_file=True, ties=("_tie",)).drop("_tie")
    hit = F.col("_n").between(start - 1, stop - 1)
    if max_test > 0:
        picked = _overall(numbered.where(hit).select(user, pos, "_n"), pos, "_m", (user, "_n"))
        last = picked.where(F.col("_m") == max_test - 1).first()
        if last:
            place = (pos, user, "_n")
            cut = [F.lit(last[name]).cast(numbered.schema[name].dataType).alias(name) for name in place]
            hit = hit & (F.struct(*place) <= F.struct(*cut))
    marked = numbered.withColumn("is_test", hit).drop("_n")
    nameless = df.where(F.col(user).isNull() | F.col(pos).isNull())
    return marked.unionByName(nameless.withColumn("is_test", F.lit(False))).select(*df.columns, "is_test")


def kfold_split(df: DataFrame, pos: str, rows_per_fold: int) -> DataFrame:
    """Add ``fold`` (from 1): consecutive runs of ``rows_per_fold`` rows in ``pos``
    order, whatever the gaps between positions. Fold i's test part is ``fold = i``,
    its base part all other rows."""
    numbered = _overall(df, pos, "_row")
    return numbered.withColumn("fold", (floor_div(F.col("_row"), rows_per_fold) + 1).cast("int")).drop("_row")


def fold_parts(df: DataFrame, fold: int, order: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Base and test part of one fold, sorted numerically when asked."""
    base = df.where(F.col("fold") != fold)
    test = df.where(F.col("fold") == fold)
    keys = [F.col(name).cast("bigint") for name in order]
    return (base.orderBy(*keys), test.orderBy(*keys)) if keys else (base, test)
